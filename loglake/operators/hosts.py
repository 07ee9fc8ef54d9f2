"""Stamp events with the latest known state of their host."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUS_FIELDS = ("hosted_on", "read_only", "replica_lag", "role")
BUCKET_SECONDS = 300


def enrich_host(
    events: DataFrame,
    status: DataFrame,
    host: str = "host",
    time: str = "_time",
    at: str = "at",
    fields: Sequence[str] = STATUS_FIELDS,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """As-of left join: the last snapshot of the host at or before the event.

    A merge of both sides in time ranges. Events and snapshots of a host and range are one
    group, in which the newest snapshot is carried over the events. What a range hands on
    is one row, its last snapshot; these rows, one per host and range, are carried over the ranges in
    which nothing was polled. Both uses of the groups read one shuffle of the events, so
    the events are computed once. A range of minutes keeps the groups of a busy host bounded.

    An event without a time or a host has no status, and likewise a snapshot has no effect. Fields the
    events already have are written over.
    """
    kept = [c for c in events.columns if c not in fields]
    told = status.filter(F.col(at).isNotNull() & F.col(host).isNotNull())
    state = F.struct(*[F.col(f).alias(f) for f in fields])
    # A snapshot stands before the events of its moment; of equal ones the greatest counts, in any order of rows.
    snapshots = told.select(F.col(host).cast("string").alias("_host"), F.col(at).cast("timestamp").alias("_at"), state.alias("_state"))
    snapshots = snapshots.groupBy("_host", "_at").agg(F.max("_state").alias("_state"))
    rows = events.select(
        F.when(F.col(time).isNotNull(), F.col(host).cast("string")).alias("_host"), F.col(time).cast("timestamp").alias("_at"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"))
    both = rows.unionByName(snapshots, allowMissingColumns=True).withColumn("_range", F.floor(F.unix_seconds("_at") / bucket_seconds))
    # Rows without a host or a time meet nothing; a hash of their fields deals them out.
    plain = [F.col(f"_row.`{f.name}`") for f in events.schema if f.name in kept and f.dataType.typeName() in ("string", "long", "timestamp", "double")]
    lost = F.when(F.col("_host").isNull(), F.pmod(F.xxhash64(*plain, F.lit(0)), F.lit(1 << 20))).otherwise(0)
    both = both.withColumn("_lost", lost.cast("int"))
    group = ["_host", "_range", "_lost"]
    in_range = Window.partitionBy(*group).orderBy("_at", F.col("_row").isNotNull())
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = both.withColumns({
        "_seen": F.when(F.col("_host").isNotNull(), F.last("_state", ignorenulls=True).over(so_far)),
        "_after": F.lead(F.lit(1)).over(in_range)})
    # The last row of a group stands for it. It is asked for the row it holds, so that both
    # branches need the same columns of the shuffled rows and share them.
    ends = merged.filter(F.col("_after").isNull() & F.col("_host").isNotNull() & (F.col("_row").isNotNull() | F.col("_seen").isNotNull()))
    ranges = Window.partitionBy("_host").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*group, F.last("_seen", ignorenulls=True).over(ranges).alias("_carried")).filter("_carried IS NOT NULL")
    joined = merged.filter("_row IS NOT NULL").join(carried, group, "left")
    known = F.coalesce("_seen", "_carried")
    return joined.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], *[known[f].alias(f) for f in fields])
