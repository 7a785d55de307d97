"""What the operators share: hand-over tables in the shared folder, row keys, Arrow maps.

Nothing here keeps a file in a machine-local folder: hand-over tables and archives go below
the folder that the cluster names in `spark.checkpoint.dir`.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch. A batch of very long texts (100 kB each) stays near 25 MB.
BATCH_ROWS = 256


@functools.cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="lintlake-shared-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see. Only a local session that names none (tests) gets one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = _test_folder()
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def handed_over(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and go on from the files.

    Cuts the lineage: a lost executor costs a re-read of files, not a second computation.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[read] = path
    return read


#: Where the tables of `handed_over` lie, as long as they are in use.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def done_with(*tables: DataFrame) -> None:
    """Delete hand-over tables that no later step reads, and let go of finished shuffles.

    Call it only when what was made of them is handed over itself. Spark removes the files
    of a shuffle once the driver's collector finds its plan unused, so that is asked to run.
    """
    for table in tables:
        spark, path = table.sparkSession, _PATHS.pop(table)
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
    tables[0].sparkSession._jvm.java.lang.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of whole texts holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_digest(text: Column) -> Column:
    """Tells rows with equal ids and different texts apart (null is empty)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def arrow_map(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(work, schema)
