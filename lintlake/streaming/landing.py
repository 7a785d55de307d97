"""Follow a folder of landed JSON lines and keep issue records as they arrive.

The same parsing and normalising expressions as in the batch chain; each micro-batch holds
the new files only. `append_records` appends what arrives. `keep_newest` holds the newest
record of every issue in the stream's keyed state, so overlapping fetches leave one row per
issue, as the batch `dedup_issues` does on the complete table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lintlake.functions import values
from lintlake.functions.text import strip
from lintlake.operators.issues import best_row, normalize
from lintlake.sources.jsonl import landed_issues


#: Where a record was landed; later places are newer fetches.
PLACE = ("file", "split_start", "row_id", "pos")


def follow_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Streaming non-blank lines of the files that appear under `path`: (value, file, split_start)."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(path)
        .select(
            strip(F.col("value")).alias("value"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split_start"),
        )
        .where("value <> ''")
    )


def follow_records(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Streaming issue records of the files that appear under `path`."""
    return normalize(landed_issues(follow_lines(spark, path, files_per_batch).select("value")))


def append_records(records: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append records as JSON lines, exactly once per input file; stops when caught up."""
    return (
        records.writeStream.format("json")
        .option("ignoreNullFields", False)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def newest_records(records: DataFrame) -> DataFrame:
    """The newest record of every issue key: newest update, then the latest place, as in `dedup_issues`.

    Rows without a key have no newer copy; each stands for itself.
    """
    keyless = F.col("issue_key").isNull()
    own = {f"_own_{c}": F.when(keyless, F.col(c)) for c in PLACE}
    updated = values.epoch_seconds(F.col("creation_date"), F.col("update_date"), "update")
    newest = [updated, *[F.col(c) for c in PLACE]]
    return best_row(records.withColumns(own), ["issue_key", *own], newest, last=True).drop(*own)


def keep_newest(lines: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Upsert the issues of every micro-batch of `follow_lines` into `table`; stops when caught up.

    A batch leaves one row per issue key that it holds, in a folder of its own; the newest
    row of a key over all folders counts (`read_newest`). A batch that is repeated after a
    failure replaces its folder, so nothing counts twice. `compact` merges the folders.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        placed = batch.withColumn("row_id", F.monotonically_increasing_id())
        newest_records(normalize(landed_issues(placed))).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return (
        lines.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_newest(spark: SparkSession, table: str) -> DataFrame:
    """The newest record of every issue, with its place; unreadable lines as rows of their own."""
    return newest_records(spark.read.parquet(table).drop("batch"))


def compact(spark: SparkSession, table: str, target: str) -> None:
    """Write the newest records to a table of their own, one row per issue key."""
    read_newest(spark, table).write.mode("overwrite").parquet(f"{target}/batch=0")
