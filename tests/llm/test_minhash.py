import hashlib

import pytest

from lintlake.llm import minhash

from .conftest import EDGE_TEXTS, prose


def jaccard(a, b, n=5):
    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_estimates_jaccard():
    s, errors = minhash.Sketcher(), []
    for seed in range(40):
        a = prose(seed, 600)
        b = " ".join(prose(1000 + seed, 100).split()[: seed * 2]) + " " + " ".join(a.split()[seed * 10 :])
        errors.append(s.likeness(s.fingerprint(a), s.fingerprint(b)) - jaccard(a, b))
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.12


def test_bias_correction():
    s = minhash.Sketcher()
    unlike = [s.likeness(s.fingerprint(prose(i, 300)), s.fingerprint(prose(i + 500, 300))) for i in range(40)]
    assert sum(unlike) / 40 < 0.03


@pytest.mark.parametrize("text", ["", "one", "one two three", prose(1, 7), prose(2, 30)])
def test_few_shingles(text):
    s = minhash.Sketcher()
    print_ = s.fingerprint(text)
    assert len(print_) == minhash.BINS * minhash.BITS // 8
    assert s.likeness(print_, minhash.Sketcher().fingerprint(text)) == 1.0


def test_densification_fills_from_filled_bins():
    s = minhash.Sketcher()
    text = prose(3, 40)
    own = {int(h & ((1 << 55) - 1)) for h in s.shingles(text)}
    assert set(map(int, s.values(text))) <= own


def test_packed_bits():
    s = minhash.Sketcher(bins=8, bits=2)
    values = [int(v) & 3 for v in s.values(prose(4, 50))]
    assert [b >> k & 3 for b in s.fingerprint(prose(4, 50)) for k in (6, 4, 2, 0)] == values
    with pytest.raises(ValueError):
        minhash.Sketcher(bins=100)


def run(df):
    return minhash.with_next(df, minhash.describe_edited, minhash.EDITED)


def check(rows, texts):
    """`texts` in the order of documents; rows in any order."""
    s, want = minhash.Sketcher(), []
    for (doc_id, text), (_, after) in zip(texts, texts[1:] + texts[:1], strict=True):
        q = len(text) // 4
        changed = text[: len(text) - q] + after[:q]
        own, edited, following = (s.fingerprint(t) for t in (text, changed, after))
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).digest(), own, edited,
                     s.likeness(own, edited), s.likeness(own, following)))
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_with_next(make):
    texts = [(i, prose(60 + i, 20 + i * 7 % 80)) for i in range(50)]
    spark = make(texts).sparkSession
    for n in ("1", "7"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        check(run(make(texts[::-1]).repartition(4)).collect(), texts)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    check(run(make(texts[:1])).collect(), texts[:1])


def test_edge_cases(edge, nothing):
    spark = edge.sparkSession
    digests = {t: d for t, d in spark.createDataFrame([(t or "",) for _, t in EDGE_TEXTS], "t string")
               .selectExpr("t", "xxhash64(t)").collect()}
    order = sorted(EDGE_TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, digests[x[1] or ""]))
    check(run(edge).collect(), [(i, t or "") for i, t in order])
    assert run(nothing).collect() == []
    assert len(minhash.fingerprints(edge).collect()) == len(EDGE_TEXTS)
