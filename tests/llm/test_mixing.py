import hashlib

import pytest

from lintlake.llm import mixing

from .conftest import prose

TARGETS = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.7, "fr": 0.3}, "topic": {"prose": 0.9, "figures": 0.1}}


def test_raking_meets_marginals():
    cells = {(s, x, t): 1000.0 * (1 + i * 7 % 5) for i, (s, x, t) in enumerate(
        (s, x, t) for s in "ab" for x in ("en", "fr") for t in ("prose", "figures"))}
    chances = mixing.rake(cells, TARGETS, keep=0.3, rounds=200)
    kept = 0.3 * sum(cells.values())
    for at, axis in enumerate(mixing.AXES):
        for name, share in TARGETS[axis].items():
            got = sum(chances[k] * n for k, n in cells.items() if k[at] == name)
            assert got == pytest.approx(share * kept, rel=1e-6)
    assert all(0 <= c <= 1 for c in chances.values())


def test_rare_categories_are_kept_whole():
    cells = {("a", "en", "prose"): 10_000.0, ("b", "en", "prose"): 100.0}
    chances = mixing.rake(cells, TARGETS, keep=0.5)
    assert chances["b", "en", "prose"] == 1.0 and chances["a", "en", "prose"] < 0.5


def test_no_target():
    with pytest.raises(ValueError):
        mixing.rake({("other", "en", "prose"): 5.0}, TARGETS)
    assert mixing.rake({}, TARGETS) == {} and mixing.rake({("a", "en", "prose"): 0.0}, TARGETS) == {}


def test_draws(make):
    docs = [(i, prose(i, 30)) for i in range(400)]
    both = make(docs, source="a").unionByName(make([(i + 400, t) for i, t in docs[:100]], source="b", lang="fr"))
    rows = mixing.drawn(both, TARGETS, keep=0.4).collect()
    for r in rows:
        draw = int(hashlib.md5(f"mix|{r._row.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        assert r.kept == (draw < r.probability) and r.tokens == 30
    kept = mixing.sample(both, TARGETS, keep=0.4)
    assert kept.columns == both.columns and kept.count() == sum(r.kept for r in rows)


def test_edge_cases(edge, nothing):
    rows = mixing.drawn(edge).collect()
    assert len(rows) == edge.count()
    assert {r.tokens for r in rows if not (r._row.text or "").strip()} == {0}
    by_id = {}
    for r in rows:
        by_id.setdefault((r._row.doc_id, r.probability), set()).add(r.kept)
    assert all(len(k) == 1 for k in by_id.values())
    strange = edge.selectExpr("doc_id", "text", "cast(null AS string) AS lang", "'nowhere' AS source")
    targets = mixing.TARGETS | {"source": {"src1": 0.5}, "lang": {"en": 0.5}}
    assert {(r.source_class, r.lang_class) for r in mixing.drawn(strange, targets).collect()} == {("other", "other")}
    assert mixing.sample(nothing).collect() == []


def test_unlisted_names_are_drawn(make):
    """Production targets sum to 1: nulls and unlisted names keep their share of the corpus."""
    listed = make([(i, prose(i, 30)) for i in range(300)])
    for other in ({"lang": None}, {"source": None}, {"lang": None, "source": "src99"}):
        alone = make([(i + 300, prose(i, 30)) for i in range(300)], **other)
        rows = mixing.drawn(alone).collect()
        assert {round(r.probability, 6) for r in rows} == {mixing.KEEP} and 150 < sum(r.kept for r in rows) < 270
        both = mixing.drawn(listed.unionByName(alone)).collect()
        assert sum(r.probability for r in both) == pytest.approx(mixing.KEEP * 600, rel=1e-3)
        assert all(r.probability > 0.5 for r in both)


def test_stage_on_null_columns(spark, make):
    import corpus_pipeline as pipeline

    stage = dict(pipeline.STAGES)["mixing"]
    docs = make([(i, prose(i, 30)) for i in range(200)], lang=None, source=None)
    assert 100 < stage(spark, docs, "").count() < 180


def test_no_target_with_tokens_is_uniform(make):
    docs = make([(i, prose(i, 30)) for i in range(20)])
    targets = mixing.TARGETS | {"lang": {"en": 0.0, "fr": 1.0}}
    assert {round(r.probability, 6) for r in mixing.drawn(docs, targets).collect()} == {mixing.KEEP}


def test_checking_sql_on_null_and_unlisted_categories(make, tmp_path):
    import duckdb

    from lintlake.llm import oracle

    docs = make([(i, prose(i, 20 + i % 50)) for i in range(150)], lang=None, source="nowhere")
    for seed, lang, source in ((1, "en", "src0"), (2, "xx", "src1"), (3, "fr", None), (4, "de", "src2")):
        docs = docs.unionByName(make([(1000 * seed + i, prose(i + seed, 30) + " 123" * (i % 2)) for i in range(120)], lang=lang, source=source))
    for name, rows in (("mixed", docs), ("strange", docs.where("source = 'nowhere'"))):
        path = str(tmp_path / name)
        rows.select("doc_id", "text", "lang", "source").write.parquet(path)
        db = duckdb.connect()
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
        cursor = db.execute(oracle.all_sql()["op6_mixing"])
        names = [d[0] for d in cursor.description]
        want = {r[names.index("doc_id")]: dict(zip(names, r, strict=True)) for r in cursor.fetchall()}
        got = mixing.drawn(rows).collect()
        assert len(want) == len(got)
        for r in got:
            w = want[r._row.doc_id]
            assert r.probability == pytest.approx(w["probability"], abs=2e-9) and r.kept == w["kept"]
            assert (r.source_class, r.lang_class, r.topic_class) == (w["source_class"], w["lang_class"], w["topic_class"])
            assert r.probability > 0
