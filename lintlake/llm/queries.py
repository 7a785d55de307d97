"""Registered queries of the operators over the shared tables: whole tables, whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintlake.session import tune

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; sessions are tuned on entry."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    _REGISTRY[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """Where the installed public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.llm import packing

    return packing.pack(
        table(spark, sf_dir, "documents"),
        tokenizer_path(),
        finish=packing.ids_crc32,
        finished="ids_crc32 long",
    )


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.llm import simhash

    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_code(F.col("code")).alias("fingerprint"), "component_id")


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.llm import minhash

    found = minhash.with_next(table(spark, sf_dir, "documents"), minhash.describe_edited, minhash.EDITED)
    shown = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return found.withColumns(shown)


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.llm import quality

    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents after removal; spans as text, in code points of the original."""
    from lintlake.llm import line_dedup

    found = line_dedup.without_repeats(table(spark, sf_dir, "documents"), details=True)
    return found.select("doc_id", "text", F.to_json("removed").alias("removed"))


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.llm import warc

    found = warc.archive_and_read(table(spark, sf_dir, "pages"), revisit_min_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The registered query's key; a caller brings a secret one.
PSEUDONYM_KEY = "registered query"


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.llm import pii

    found = pii.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return found.select("doc_id", "text", "n_replaced")


@query
def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.llm import embedding_dedup

    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.llm import lm

    return lm.score(table(spark, sf_dir, "documents"))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, its calibrated probability and whether it is drawn."""
    from lintlake.llm import mixing

    found = mixing.drawn(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), *[f"{a}_class" for a in mixing.AXES], "tokens",
        F.round("probability", 9).alias("probability"), "kept",
    )


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.llm import centroids

    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base measures of every document; what they reject meets no further rule."""
    from lintlake.llm import quality_rules as rules

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    others = [r for r in rules.RULES if r.name not in ("length", "repeated_words")]
    ordered = rules.in_order(others, rules.profile(documents, others))
    found = documents
    for layer in (("words", "lines"), ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")):
        given = rules.Given(F.col("text"), **{c: F.col(c) for c in found.columns[2:]})
        found = found.withColumns({name: given.of(getattr(rules, name)) for name in layer})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = found.drop("words", "lines").withColumn("base_failed", failed)
    given = rules.Given(F.col("text"), **{c: F.col(c) for c in found.columns[2:]})
    kept = F.when(F.col("base_failed"), False).otherwise(rules.first_broken(given, ordered).isNull())
    return found.withColumn("kept", kept).drop("text", "n_lines")


@query
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with faults put in by a checksum, audited and repaired."""
    from lintlake.llm import conversation_repair as repair

    rows = table(spark, sf_dir, "conversations")
    return repair.audit(repair.damaged(rows), rows).drop("n_rows")
