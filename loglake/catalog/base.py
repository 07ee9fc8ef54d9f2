"""Registry of queries with the SQL that computes the same from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.session import fresh_path, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ROWS_A_TASK = 100_000

_written: dict[tuple[str, str, str], str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Give a table with fewer splits than there are cores a split per core.

    Only small tables are shuffled by this; a large one has more splits and stays.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame) -> DataFrame:
    """The table in tasks of about ``ROWS_A_TASK`` rows, for rows that make much work each.

    Splits are cut by bytes and hold whole row groups: some get none, and the others more rows the larger the
    table is. Counting reads the footers only; the rows that are shuffled are those of the table, not what is made of them.
    """
    wanted = -(-df.count() // ROWS_A_TASK)
    return df.repartition(wanted) if wanted > df.sparkSession.sparkContext.defaultParallelism else df


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def written(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> str:
    """Text files of rendered log lines, made once per session from a table.

    A row may hold several lines; they stay together and in order in its file.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = fresh_path(spark, name)
        make().write.option("lineSep", "\n").text(path)
        _written[key] = path
    return _written[key]


def stamp_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def text(col: Column | str, kind: str = "string") -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.cast(kind).cast("string")


def money(col: str) -> Column:
    return F.col(col).cast("decimal(18,2)")
