"""The pipeline's stages on the smallest shared tables, each held against its own input."""

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from lintlake.llm import line_dedup, mixing, quality
from lintlake.llm.queries import all_queries
from lintlake.llm.shared import handed_over

from .test_line_dedup import check_removed
from .test_simhash import classes, plain_fingerprint

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables not present")


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        docs.append(handed_over(stage(spark, docs[-1], SF_DIR), name))
    return docs


def test_registered():
    names = contract.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in all_queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(all_queries()) <= set(names)


def test_columns(steps):
    assert all(d.columns == steps[0].columns for d in steps[:-1])


def test_quality_stage(spark, steps):
    score = quality.score(steps[0], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert {r.doc_id for r in steps[1].collect()} == {r.doc_id for r in score.where("predicted = 1").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").collect()}
    assert len(good - {r.doc_id for r in steps[1].collect()}) <= 0.05 * len(good)


def test_line_stage(steps):
    before = sorted((r.doc_id, r.text) for r in steps[1].collect())
    found = {r.doc_id: r for r in line_dedup.without_repeats(steps[1], details=True).collect()}
    check_removed(before, found.values())
    assert {r.doc_id: r.text for r in steps[2].collect()} == {i: r.text for i, r in found.items()}
    assert any(r.removed for r in found.values())


def test_simhash_stage(steps):
    docs = sorted((r.doc_id, plain_fingerprint(r.text)) for r in steps[2].collect())
    n = len(docs)
    pairs = [(i, j) for i in range(n) for j in range(i) if (docs[i][1] ^ docs[j][1]).bit_count() <= 2]
    root = classes(n, pairs)
    assert {r.doc_id for r in steps[3].collect()} == {docs[i][0] for i in range(n) if root[i] == i}


def test_mixing_stage(steps):
    want = {r._row.doc_id for r in mixing.drawn(steps[3]).where("kept").collect()}
    assert {r.doc_id for r in steps[4].collect()} == want and want


def test_packing_stage(spark, steps):
    lengths = {r.doc_id: r.doc_tokens for r in steps[5].collect()}
    assert set(lengths) == {r.doc_id for r in steps[4].collect()}
    assert steps[5].agg({"length": "sum"}).first()[0] == sum(lengths.values())
    assert pipeline.run(spark, SF_DIR).count() == steps[5].count()
