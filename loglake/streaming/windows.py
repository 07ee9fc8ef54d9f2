"""Windowed counts on streams; they alone carry a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate_window(events: DataFrame, key: Column, seconds: int = 30, delay: str = "1 minute", time: str = "_time") -> DataFrame:
    """Rows per key and tumbling window: what dynamic sampling sets its rates by."""
    counted = events.withWatermark(time, delay).groupBy(F.window(time, f"{seconds} seconds").alias("w"), key.alias("sample_key"))
    return counted.agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "sample_key", "n")


def status_window(
    outcomes: DataFrame, duration: str, seconds: int = 60, delay: str = "1 minute", time: str = "_time"
) -> DataFrame | None:
    """Count and durations per status and interval; an interval of 0 turns it off."""
    if seconds == 0:
        return None
    grouped = outcomes.withWatermark(time, delay).groupBy(F.window(time, f"{seconds} seconds").alias("w"), "status")
    return grouped.agg(
        F.count("*").alias("n"),
        F.min(duration).alias("fastest"),
        F.max(duration).alias("slowest"),
        F.sum(duration).alias("total"),
    ).select(F.col("w.start").alias("window_start"), "status", "n", "fastest", "slowest", "total")


def late_events(events: DataFrame, delay: str, seconds: int, time: str = "_time", arrival: str = "arrival") -> DataFrame:
    """Rows whose window had closed when they arrived: the windows miss them, the table has them."""
    end = F.timestamp_seconds((F.floor(F.unix_seconds(time) / seconds) + 1) * seconds)
    return events.filter(end + F.expr(f"INTERVAL {delay}") <= F.col(arrival))
