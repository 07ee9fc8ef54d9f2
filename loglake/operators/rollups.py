"""Rollups of the tables the formats fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.operators.quantiles import exact_quantile
from loglake.session import staged

MICROS = 1_000_000


def _micros(seconds: Column) -> Column:
    """Seconds as whole microseconds: sums are exact and do not depend on row order."""
    return F.round(seconds * MICROS).cast("bigint")


def fingerprint_id(text: Column) -> Column:
    """128 bits that stand for a fingerprint; a missing one has an id of its own."""
    return F.when(text.isNull(), F.unhex(F.lit("00"))).otherwise(F.unhex(F.md5(text)))


def slow_query_digest(events: DataFrame, top: int | None = None) -> DataFrame:
    """Per fingerprint: calls, time (total, average over timed calls, p95, maximum), rows, share of all time.

    Runs one job at once, which reads the events once and counts them on two levels: per fingerprint,
    with its text and its totals, and per fingerprint and time, by a 128-bit id. So a text is moved once
    per distinct fingerprint and task, however many times it took. The p95 is exact: times are summed into a
    bounded histogram, and of the one bucket that holds it they are looked at singly.
    """
    weight = F.coalesce(F.col("sample_rate"), F.lit(1)) if "sample_rate" in events.columns else F.lit(1)
    us = _micros(F.col("query_time"))
    known = events.select(
        fingerprint_id(F.col("normalized_query")).alias("id"), "normalized_query", us.alias("us"), weight.cast("bigint").alias("n"),
        "rows_examined", "rows_sent")
    # One pass over the events feeds both levels; each row is expanded before it is combined, not read again.
    levels = known.groupingSets([["id", "normalized_query"], ["id", "us"]], "id", "normalized_query", "us").agg(
        F.grouping("us").alias("_total"),
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("us").isNotNull(), F.col("n"))).alias("timed"),
        # All time of a large log is more microseconds than a BIGINT holds.
        F.sum(F.col("us").cast("decimal(20,0)") * F.col("n")).alias("time_us"),
        F.max("us").alias("max_us"),
        F.sum(F.col("rows_examined") * F.col("n")).alias("rows_examined"),
        F.sum(F.col("rows_sent") * F.col("n")).alias("rows_sent"),
    )
    counted = staged(levels, "query-times")
    base = counted.filter("_total = 1").withColumn("total_us", F.col("time_us").cast("double"))
    values = counted.filter("_total = 0 AND us IS NOT NULL").select("id", "us", "n")
    p95 = exact_quantile(values, ["id"], "us", 950, "p95_us")
    all_time = base.agg(F.sum("total_us")).scalar()
    digest = base.join(p95, "id", "left").select(
        "normalized_query",
        F.col("n").alias("calls"),
        (F.col("total_us") / MICROS).alias("total_time"),
        (F.col("total_us") / F.col("timed") / MICROS).alias("avg_time"),
        (F.col("p95_us") / MICROS).alias("p95_time"),
        (F.col("max_us") / MICROS).alias("max_time"),
        "rows_examined",
        "rows_sent",
        (F.col("total_us") / all_time).alias("time_share"),
    )
    return digest if top is None else ranked_top(digest, "total_time", "normalized_query", top)


def ranked_top(df: DataFrame, measure: str, tie: str, top: int) -> DataFrame:
    """The first ``top`` rows with their rank: cut first, so only those rows are numbered."""
    cut = df.orderBy(F.col(measure).desc(), tie).limit(top)
    return cut.withColumn("rank", F.rank().over(Window.orderBy(F.col(measure).desc())))


def traffic_by_shape(events: DataFrame, method: str, shape: str, status: str, size: str) -> DataFrame:
    """Requests and bytes per method, shape and status, with subtotals.

    Counted on the finest level first, so the rollup expands groups and not rows.
    """
    finest = events.groupBy(
        F.col(method).alias("method"), F.col(shape).alias("shape"), F.col(status).alias("status")
    ).agg(F.count("*").alias("_n"), F.sum(size).alias("_bytes"))
    return finest.rollup("method", "shape", "status").agg(
        F.sum("_n").alias("requests"), F.sum("_bytes").alias("bytes"), F.grouping_id().alias("level")
    )


def audit_activity(events: DataFrame) -> DataFrame:
    """Actions and distinct users over every combination of user, host and command class."""
    finest = events.groupBy("user", "host", "command_class").agg(F.count("*").alias("_n"))
    return finest.withColumn("_who", F.col("user")).cube("user", "host", "command_class").agg(
        F.sum("_n").alias("actions"),
        F.count_distinct("_who").alias("users"),
        F.grouping_id().alias("level"),
    )


def audit_users_approx(events: DataFrame, by: list[str]) -> DataFrame:
    """Approximate distinct users: one bounded sketch per group."""
    return events.groupBy(*by).agg(F.approx_count_distinct("user").alias("users"), F.count("*").alias("actions"))


def slow_by_table(events: DataFrame) -> DataFrame:
    """Cost per table named in a statement; a statement counts for each of its tables."""
    named = events.select(F.explode(F.split("tables", " ")).alias("table"), "query_time", "rows_examined")
    return named.groupBy("table").agg(
        F.count("*").alias("calls"),
        (F.sum(_micros(F.col("query_time"))) / MICROS).alias("total_time"),
        F.sum("rows_examined").alias("rows_examined"),
    )
