"""A training-data pipeline over the documents table, stage by stage.

Each stage works on all that its predecessor kept and returns the columns of documents;
the last one returns the packed pieces. A stage's result is written as Parquet and read
again before the next one, so an executor lost later costs no earlier work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lintlake.llm import line_dedup, mixing, packing, quality, simhash
from lintlake.llm.queries import table, tokenizer_path
from lintlake.llm.shared import handed_over
from lintlake.session import tune


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred before, in this document or an earlier one, go."""
    return line_dedup.without_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: SimHash of three-word shingles, two bits of difference at most."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample to the target shares of source, language and topic."""
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, piece by piece, with the ids."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The quality classifier is fitted, so SQL cannot state the pipeline's rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = handed_over(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
