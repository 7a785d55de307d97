import math
import zlib

import numpy as np
import pytest

from lintlake.llm import quality

from .conftest import EDGE_TEXTS, prose


def labelled(make, n=300):
    """Prose is good; shouting, repetition and symbols are not."""
    rows = []
    for i in range(n):
        text = prose(i, 60)
        if i % 3 == 0:
            text = [text.upper().replace(" ", "!! "), " ".join(["same"] * 80), text.replace(" ", "### ")][i // 3 % 3]
        rows.append((i, text))
    docs = make(rows)
    labels = docs.sparkSession.createDataFrame([(i, int(i % 3 != 0)) for i, _ in rows], "doc_id long, quality int")
    return docs, labels


def test_held_out_accuracy(make):
    docs, labels = labelled(make)
    rows = quality.score(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and sum(r.predicted == (r.doc_id % 3 != 0) for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_labels_of_held_out_rows_are_not_used(make):
    docs, labels = labelled(make, 150)
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    one = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    assert one == {r.doc_id: r.score for r in quality.score(docs, other).collect()}


def test_column_equals_rules(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, len(quality.STATISTICS)))
    y = ((x[:, 2] > 0.5) & (x[:, 6] <= 0.7) | (rng.random(400) < 0.05)).astype(float)
    model = quality.fit_rules(x, y)
    assert 0 < len(model.rules) < 200 and len({len(r) for r in model.rules}) > 1
    table = spark.createDataFrame([(i, *row) for i, row in enumerate(x.tolist())], ["i", *quality.STATISTICS])
    got = {r.i: r.s for r in table.select("i", model.column().alias("s")).collect()}
    for i, row in enumerate(x):
        z = model.bias + sum(w for w, rule in zip(model.weights, model.rules, strict=True)
                             if all(row[a] > t if up else row[a] <= t for a, t, up in rule))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
    assert np.mean([(got[i] >= 0.5) == bool(v) for i, v in enumerate(y)]) > 0.93


def test_lasso_drops_rules():
    rng = np.random.default_rng(2)
    holds = rng.random((500, 30)) < 0.5
    y = holds[:, 3].astype(float)
    _, weights = quality.fit_lasso(holds, y, penalty=0.02)
    assert weights[3] > 1 and np.count_nonzero(weights) < 10


def test_edge_cases(edge, nothing, make):
    spark = edge.sparkSession
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (4, 1), (99, 0)], "doc_id long, quality int")
    rows = quality.score(edge, labels).collect()
    assert len(rows) == len(EDGE_TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    none = labels.where("false")
    assert {r.score for r in quality.score(edge, none).collect()} == {0.5}
    good = labels.where("quality = 1 AND doc_id = 4")
    assert all(r.score > 0.99 for r in quality.score(edge, good).collect())
    assert quality.score(nothing, labels).collect() == [] and quality.keep_good(nothing, labels).collect() == []
    assert quality.keep_good(edge, none).count() == len(EDGE_TEXTS)


def test_sample_is_the_smallest_hashes(make, monkeypatch):
    docs, labels = labelled(make, 3000)
    seen = []
    monkeypatch.setattr(quality, "fit_rules", lambda x, y: seen.append(x) or quality.RuleModel(0.0, (), ()))
    stated = quality._stated(docs, "doc_id", "text")
    quality.train(stated, labels, max_train=100)
    rows = stated.where(~quality.held_out(quality.F.col("doc_id"))).orderBy(quality.F.xxhash64("doc_id")).limit(100)
    want = np.array([[r[n] for n in quality.STATISTICS] for r in rows.collect()])
    assert np.array_equal(seen[0], want)
