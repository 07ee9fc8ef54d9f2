import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from loglake.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("loglake-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)


@pytest.fixture
def lines(spark):
    """A line table of one file from a list of texts."""
    def make(texts, file="f"):
        rows = [(file, 0, i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "file string, block bigint, pos bigint, value string").coalesce(1)

    return make


@pytest.fixture
def first(spark):
    """Evaluate columns over one row of texts."""
    def run(make_column, *texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
        from pyspark.sql import functions as F

        return [r[1] for r in df.select("i", make_column(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
