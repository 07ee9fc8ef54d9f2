"""Date-partitioned tables: fit, write, read."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.schemas import TableSpec
from loglake.session import with_setting
from loglake.sources.runs import committed

# A task sorts what its shuffled bytes unfold to, about thirty times as much for rows of maps.
TASK_BYTES_KEY, TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 8 * 1024 * 1024

_HELPERS = {"file", "block", "pos", "value", "reject_reason", "sample_rate", "data", "extra"}


def conform(events: DataFrame, table: TableSpec, renames: dict[str, str] | None = None) -> DataFrame:
    """Fit events to a declared table: cast known fields, keep the others in ``extra``.

    A value that does not fit its type becomes NULL and its text stays in ``extra``.
    Fields may come as columns or as keys of a ``data`` map.
    """
    renames = renames or {}
    have = {c: F.col(f"`{c}`") for c in events.columns if c not in _HELPERS}
    in_map = F.col("data") if "data" in events.columns else None
    known = dict(table.columns)
    out: list[Column] = []
    extra: list[Column] = []
    for name, kind in table.columns:
        source = renames.get(name, name)
        if source in have:
            col = have[source]
        elif in_map is not None:
            col = F.element_at(in_map, F.lit(source))
        else:
            col = F.lit(None)
        fitted = col.cast(kind) if kind in ("string", "timestamp", "date") else col.try_cast(kind)
        out.append(fitted.alias(name))
        if kind not in ("string", "timestamp", "date") and (source in have or in_map is not None):
            extra.append(_entry(name, F.when(fitted.isNull(), col.cast("string"))))
    taken = {renames.get(n, n) for n in known}
    for name, col in have.items():
        if name not in taken and name not in known:
            extra.append(_entry(name, _text(events, name, col)))
    parts = [F.map_from_entries(F.filter(F.array(*extra), lambda e: e["value"].isNotNull()))] if extra else []
    if in_map is not None:
        left_over = F.map_filter(in_map, lambda k, v: ~k.isin(*taken))
        parts.insert(0, F.coalesce(left_over, F.create_map().cast("map<string,string>")))
    if "extra" in events.columns:
        parts.insert(0, F.coalesce(F.col("extra"), F.create_map().cast("map<string,string>")))
    merged = F.map_concat(*parts) if len(parts) > 1 else (parts[0] if parts else F.create_map().cast("map<string,string>"))
    keep = [c for c in ("file", "pos", "sample_rate", "reject_reason", "value") if c in events.columns]
    return events.select(*out, *keep, merged.alias("extra"))


def _entry(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), value.alias("value"))


def _text(events: DataFrame, name: str, col: Column) -> Column:
    kind = events.schema[name].dataType.typeName()
    return F.to_json(col) if kind in ("array", "map", "struct", "variant") else col.cast("string")


def write_table(
    events: DataFrame,
    path: str,
    sort_by: Sequence[str] = ("_time",),
    mode: str = "append",
    extra_partitions: Sequence[str] = (),
) -> None:
    """Append to a table partitioned by date, sorted inside its files.

    The rebalance hint shuffles by date but lets AQE split a date that holds much
    of the data over many tasks and join small dates, so no task owns a whole day. The size a
    task is given is small, since a task holds its rows unpacked while it sorts them.
    """
    by = [*extra_partitions, "_date"]
    laid_out = events.hint("rebalance", *by).sortWithinPartitions(*by, *sort_by)
    with with_setting(events.sparkSession, TASK_BYTES_KEY, str(TASK_BYTES)):
        laid_out.write.mode(mode).partitionBy(*by).parquet(path)


def with_outcome(parsed: DataFrame) -> DataFrame:
    """Mark rows ``ok`` or ``rejected``; the raw text stays with rejected rows only."""
    bad = F.col("reject_reason").isNotNull()
    marked = parsed.withColumn("_outcome", F.when(bad, "rejected").otherwise("ok"))
    return marked.withColumn("value", F.when(bad, F.col("value"))) if "value" in parsed.columns else marked


def write_outcome(parsed: DataFrame, path: str, sort_by: Sequence[str] = ("_time",), mode: str = "append") -> None:
    """Events and rejects in one pass over the parse: ``_outcome=ok|rejected`` folders."""
    write_table(with_outcome(parsed), path, sort_by, mode, ["_outcome"])


def read_table(
    spark: SparkSession,
    path: str,
    date_from: date | str | None = None,
    date_to: date | str | None = None,
) -> DataFrame:
    """One inclusive date range; only its folders are read. Of a job's dataset, the committed batches."""
    table = committed(spark, path)
    if date_from is not None:
        table = table.filter(F.col("_date") >= F.lit(str(date_from)).cast("date"))
    if date_to is not None:
        table = table.filter(F.col("_date") <= F.lit(str(date_to)).cast("date"))
    return table


def read_events(
    spark: SparkSession, path: str, date_from: date | str | None = None, date_to: date | str | None = None
) -> DataFrame:
    """The events of a table written with ``write_outcome``."""
    table = read_table(spark, path, date_from, date_to).filter(F.col("_outcome") == "ok")
    return table.drop("_outcome", "reject_reason", "value", "_run", "_batch")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """What did not parse, with the reason; only its folders are read."""
    rejected = committed(spark, path).filter(F.col("_outcome") == "rejected")
    return rejected.select("file", "pos", "value", "reject_reason")
