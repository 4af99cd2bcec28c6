import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session("4", shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SMALL):
        pytest.skip("the driver's tables are not here")
    return SMALL


@pytest.fixture
def column(spark):
    """Apply a column function to a list of values and return the results in order."""
    from pyspark.sql import functions as F

    def apply(values, kind, function):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        done = rows.select("i", function(F.col("x")).alias("y")).orderBy("i")
        return [row["y"] for row in done.collect()]

    return apply


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
