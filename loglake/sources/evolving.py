"""Fields whose types follow from the data and may widen from batch to batch.

A format with a map of fields has no declared columns. Of each batch the keys that a share of
its rows hold become columns ``fields.<key>``, stored by type: a Parquet column for truth values, whole
numbers, other numbers and text each. The types seen are noted beside the dataset, per run, as points of a lattice;
their widest says how a key is read. Batches with different types are files with other parts filled, so none is
written again when a type widens, and a read of some fields reads their columns only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.functions.typing import as_type, exact_parts, type_of, widest
from loglake.session import staged
from loglake.sources.runs import committed

TYPES = "_types"
MOST_COLUMNS = 400


def key_types(events: DataFrame, data: str = "data") -> DataFrame:
    """(key, type, n): rows by key and type of value. Empty values have no type."""
    pairs = events.select(F.explode(data).alias("key", "value")).filter("value <> ''")
    return pairs.groupBy("key", type_of(exact_parts(F.col("value"))).alias("type")).agg(F.count("*").alias("n"))


def frequent_keys(types: DataFrame, rows: int, share: float) -> list[str]:
    """Keys that this share of the rows hold, most frequent first. A name that differs by case only from a chosen one is left out."""
    held = types.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= share * rows)
    chosen: dict[str, str] = {}
    for row in held.orderBy(F.desc("n"), "key").limit(MOST_COLUMNS).collect():
        chosen.setdefault(row["key"].lower(), row["key"])
    return list(chosen.values())


def with_fields(events: DataFrame, keys: Sequence[str], data: str = "data") -> DataFrame:
    """Move the values of these keys from the map to ``fields``; empty ones stay in the map."""
    if not keys:
        return events
    value = lambda k: F.element_at(data, F.lit(k))
    fields = F.struct(*[exact_parts(F.when(value(k) != "", value(k))).alias(k) for k in keys])
    rest = F.map_filter(data, lambda k, v: ~k.isin(*keys) | (v == ""))
    return events.withColumn("fields", fields).withColumn(data, rest)


def evolve(events: DataFrame, dataset: str, run: str, number: int, share: float, data: str = "data") -> DataFrame:
    """The events with their frequent keys as typed fields; notes the types. Reads the events once, staged."""
    kept = staged(events, "untyped")
    types = staged(key_types(kept, data), "key-types")
    keys = frequent_keys(types, kept.count(), share)
    spark = events.sparkSession
    earlier = noted(spark, dataset, run)
    mine = types.filter(F.col("key").isin(keys)).select("key", "type").distinct()
    both = mine if earlier is None else mine.unionByName(earlier.select("key", "type")).distinct()
    both.coalesce(1).write.mode("overwrite").parquet(f"{dataset}/{TYPES}/{run}/{number % 2}")
    return with_fields(kept, keys, data)


def noted(spark: SparkSession, dataset: str, run: str | None = None) -> DataFrame | None:
    """(key, type) of all runs, or of one; None where no types are noted."""
    reader = spark.read.schema("key string, type string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        rows = reader.parquet(f"{dataset}/{TYPES}/{run}" if run else f"{dataset}/{TYPES}")
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return None
        raise
    return staged(rows.distinct(), "noted-types")


def field_types(spark: SparkSession, dataset: str) -> dict[str, str]:
    """The type each promoted key is read as; at most as many as the datasets' columns."""
    rows = noted(spark, dataset)
    if rows is None:
        return {}
    wide = rows.groupBy("key").agg(widest(F.collect_set("type")).alias("type"))
    return {r["key"]: r["type"] for r in wide.collect()}


def read_typed(
    spark: SparkSession, dataset: str, names: Sequence[str] | None = None, date_from: date | str | None = None, date_to: date | str | None = None
) -> DataFrame:
    """Events with their fields as columns of one type each; only the columns of the fields asked for are read.

    A key that some batch holds too rarely to promote is in that batch's map only (``data``, or ``extra`` of a declared table, of ``read_events``).
    """
    types = field_types(spark, dataset)
    names = list(types) if names is None else list(names)
    table = committed(spark, dataset, merge_schema=True).filter("_outcome = 'ok'")
    if date_from is not None:
        table = table.filter(F.col("_date") >= F.lit(str(date_from)).cast("date"))
    if date_to is not None:
        table = table.filter(F.col("_date") <= F.lit(str(date_to)).cast("date"))
    stored = {f.name for f in table.schema["fields"].dataType.fields} if "fields" in table.columns else set()

    def column(name: str):
        if name not in stored:
            return F.element_at("data" if "data" in table.columns else "extra", F.lit(name)).alias(name)
        return as_type(F.col(f"fields.`{name}`"), types[name]).alias(name)

    return table.select("_time", "_date", *[column(n) for n in names])
