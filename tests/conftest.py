import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lintlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", memory="4g")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Apply a column function to a list of values: evaluate(fn, [v, …], 'type')."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]

    return run
