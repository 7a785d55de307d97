"""Cutting lineage at small hand-over tables.

A reliable checkpoint survives the loss of executors. Its folder is the one the cluster
names in `spark.checkpoint.dir`; only a local session that names none (tests) gets one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lintlake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Whether Spark removes the files of a query's shuffles as soon as the query has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffles of what is written inside go once it is written, not when the driver collects its garbage."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(TIDY)
        else:
            spark.conf.set(TIDY, before)


def write_over(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write `df` as Parquet to `path` and go on from all that is there."""
    with tidy(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hand_over(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and go on from the files.

    For tables of any size that several readers would otherwise compute again: each reads
    the columns it needs. The shuffles behind the table are gone when it is written.
    """
    return write_over(df, new_folder(df.sparkSession, name))


def bytes_of(table: DataFrame) -> int:
    """Bytes of the files of a handed-over table."""
    spark = table.sparkSession
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f) for f in {f.rpartition("/")[0] for f in table.inputFiles()}]
    conf = spark._jsc.hadoopConfiguration()
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in paths)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
