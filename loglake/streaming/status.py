"""Counts and durations per status and interval, beside the table of a stream.

Each batch is counted from what it has written, so lines are read once for both. The state between
batches is the counts of windows that are still open, and the watermark: the newest time seen
less the delay. A row whose window had closed before its batch came is in the table and in no window.
Windows are written once, by the batch that closes them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.session import staged
from loglake.sources.runs import folder, notes
from loglake.streaming.state import Slots

STATUS = "_status"
# What a call took, by format.
DURATIONS = {"mysql_slow": "query_time", "postgres": "duration", "access_log": "request_time", "mongo": "duration_ms", "arango": "totalTime"}
_COUNTS = "window_start timestamp, status string, n long, fastest double, slowest double, total double"
_SUMS = [F.sum, F.min, F.max, F.sum]


def report_status(
    spark: SparkSession, dataset: str, run: str, number: int, memory: Slots, seconds: int, delay_seconds: int, duration: str | None = None
) -> None:
    """Count the batch that was just written, and write the windows that it closes."""
    earlier = memory.read()
    known = earlier.filter("window_start IS NULL").agg(F.max("watermark")).first()[0] if earlier is not None else None
    rows = _written(spark, folder(dataset, run, number))
    took = F.col(duration).cast("double") if rows is not None and duration in rows.columns else F.lit(None).cast("double")
    if rows is not None:
        told = rows.filter("_time IS NOT NULL").select(F.unix_seconds("_time").alias("at"), F.col("_outcome").alias("status"), took.alias("took"))
        start = F.floor(F.col("at") / seconds) * seconds
        # Late rows carry the time forward like all others, but no closed window changes.
        newest = told.agg(F.max("at")).first()[0]
        on_time = told.withColumn("start", start).filter(F.lit(known is None) | (F.col("start") + seconds > F.lit(known)))
        fresh = on_time.groupBy(F.timestamp_seconds("start").alias("window_start"), "status").agg(
            F.count("*").alias("n"), F.min("took").alias("fastest"), F.max("took").alias("slowest"), F.sum("took").alias("total"))
    else:
        newest, fresh = None, spark.createDataFrame([], _COUNTS)
    if earlier is not None:
        fresh = fresh.unionByName(earlier.filter("window_start IS NOT NULL").drop("watermark"))
    names = ["n", "fastest", "slowest", "total"]
    open_ = staged(fresh.groupBy("window_start", "status").agg(*[f(c).alias(c) for f, c in zip(_SUMS, names, strict=True)]), "status-windows")
    marks = [m for m in (known, None if newest is None else newest - delay_seconds) if m is not None]
    mark = max(marks, default=None)
    done = F.lit(mark is not None) & (F.unix_seconds("window_start") + seconds <= F.lit(mark))
    kept = open_.filter(~F.coalesce(done, F.lit(False))).withColumn("watermark", F.lit(None).cast("long"))
    memory.write(kept.unionByName(spark.createDataFrame([(mark,)], "watermark long"), allowMissingColumns=True))
    closed = open_.filter(F.coalesce(done, F.lit(False)))
    closed.coalesce(1).write.mode("overwrite").parquet(folder(f"{dataset}/{STATUS}", run, number))


def _written(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            return None
        raise


def read_status(spark: SparkSession, dataset: str) -> DataFrame:
    """The closed windows of all streams of a dataset."""
    done = notes(spark, dataset).select(F.col("run").alias("_run"), F.col("upto").alias("_upto"))
    windows = spark.read.option("basePath", f"{dataset}/{STATUS}").parquet(f"{dataset}/{STATUS}/_run=*")
    return windows.join(done, "_run").filter("_batch <= _upto").select("window_start", "status", "n", "fastest", "slowest", "total")
