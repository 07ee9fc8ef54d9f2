"""Counters of outcomes, durations and ingest quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_window(df: DataFrame, seconds: int, time: str = "_time") -> DataFrame:
    """Add ``window_start``, the start of the tumbling window a row falls in."""
    return df.withColumn("window_start", F.timestamp_seconds(F.floor(F.unix_seconds(time) / seconds) * seconds))


def outcome_counts(outcomes: DataFrame, fields: Sequence[str] = ("status", "message", "error"), seconds: int = 60) -> DataFrame:
    """Per window: rows by status, by message and by error, as ``(window_start, kind, item, n)``.

    Counted once on all fields, then by each: one shuffle of rows, one of groups.
    """
    finest = with_window(outcomes, seconds).groupBy("window_start", *fields).agg(F.count("*").alias("_n"))
    pairs = F.array(*[F.struct(F.lit(f).alias("kind"), F.col(f).cast("string").alias("item")) for f in fields])
    return (
        finest.select("window_start", "_n", F.explode(pairs).alias("_p"))
        .filter(F.col("_p.item").isNotNull())
        .groupBy("window_start", F.col("_p.kind").alias("kind"), F.col("_p.item").alias("item"))
        .agg(F.sum("_n").alias("n"))
    )


def duration_stats(outcomes: DataFrame, duration: str, seconds: int = 60) -> DataFrame:
    """Count, fastest, slowest and average per window."""
    return with_window(outcomes, seconds).groupBy("window_start").agg(
        F.count("*").alias("n"),
        F.min(duration).alias("fastest"),
        F.max(duration).alias("slowest"),
        F.avg(duration).alias("average"),
    )


def lifetime_totals(per_window: DataFrame, value: str = "n", at: str = "window_start") -> DataFrame:
    """Running total over windows.

    Summed inside each day, plus what the days before add up to: only one row per
    day passes through the window that has no partition.
    """
    daily = per_window.withColumn("_day", F.to_date(at))
    in_day = Window.partitionBy("_day").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = daily.groupBy("_day").agg(F.sum(value).alias("_sum"))
    base = days.select("_day", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    summed = daily.withColumn("_in", F.sum(value).over(in_day))
    # Rows without a time are a day of their own, before all others.
    running = summed.join(base, summed["_day"].eqNullSafe(base["_day"])).drop(base["_day"])
    return running.withColumn("lifetime", F.col("_in") + F.col("_base")).drop("_day", "_in", "_base")


def last_event(events: DataFrame, fields: Sequence[str], seconds: int = 60, order: Sequence[str] = ("_time", "pos")) -> DataFrame:
    """The newest event of each window."""
    newest = F.max_by(F.struct(*fields), F.struct(*order)).alias("_e")
    return with_window(events, seconds).groupBy("window_start").agg(newest).select("window_start", "_e.*")


def ingest_quality(lines: DataFrame, parsed: DataFrame) -> DataFrame:
    """Per file and day: lines read, events made, rejects by reason.

    Lines carry no day, so their count stands on the row of the file with day NULL;
    rejects without a time stand there too.
    """
    read = lines.groupBy("file").agg(F.count("*").alias("_lines"))
    made = parsed.groupBy("file", F.to_date("_time").alias("_date"), "reject_reason").agg(F.count("*").alias("_n"))
    # Both are counts by now; they are put under one another and added up, not joined.
    both = made.unionByName(read.withColumn("_date", F.lit(None).cast("date")), allowMissingColumns=True)
    good, bad = F.col("reject_reason").isNull(), F.col("reject_reason").isNotNull()
    return both.groupBy("file", "_date").agg(
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("lines"),
        F.coalesce(F.sum(F.when(good, F.col("_n"))), F.lit(0)).alias("events"),
        F.coalesce(F.sum(F.when(bad, F.col("_n"))), F.lit(0)).alias("rejects"),
        F.map_from_entries(F.collect_list(F.when(bad, F.struct("reject_reason", "_n")))).alias("reasons"),
    )
