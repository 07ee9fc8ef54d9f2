"""One JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.documents import parse_whole
from loglake.functions.text import settled, trim_space
from loglake.functions.times import TIME_FIELDS, time_hits
from loglake.operators.lines import over, strip_prefix

_FIELDS = "map<string,variant>"


def object_fields(text: Column) -> Column:
    """Fields of a JSON object; NULL for bad JSON and for anything but an object."""
    return parse_whole(text).try_cast(_FIELDS)


def text_of(field: Column) -> Column:
    """The value of a variant that holds a string; NULL for other types."""
    return F.when(F.schema_of_variant(field) == "STRING", F.try_variant_get(field, "$", "string"))


def json_events(
    lines: DataFrame,
    ingest_time: Column | None = None,
    time_field: str | None = None,
    time_format: str | None = None,
    tz: str = "UTC",
    prefix: str | None = None,
) -> DataFrame:
    """Events with ``data MAP<STRING, VARIANT>``: keys stay case-sensitive.

    The time is taken from the object before prefix fields are merged in.
    """
    late = ingest_time if ingest_time is not None else F.lit(None).cast("timestamp")
    cut = strip_prefix(lines.withColumn("value", trim_space(F.col("value"))), prefix)
    parsed = cut.withColumn("_fields", object_fields(F.col("value")))
    names = (time_field,) if time_field else TIME_FIELDS
    hits = time_hits(names, lambda n: text_of(F.element_at("_fields", n)), time_format, tz)
    timed = parsed.withColumn("_hits", hits)
    timed = timed.withColumn("_hit", F.get(F.filter("_hits", lambda h: h["t"].isNotNull()), F.lit(0)))
    used = F.coalesce(F.col("_hit.n"), F.lit(time_field) if time_field else F.try_element_at("_hits", F.lit(-1))["n"])
    timed = timed.withColumn("_used", used)
    rest = F.map_filter("_fields", lambda k, v: ~k.eqNullSafe(F.col("_used")))
    above = F.transform_values("prefix", lambda k, v: v.cast("variant"))
    return timed.select(
        "file", "block", "pos", "value",
        F.when(F.col("_fields").isNotNull(), F.coalesce(F.col("_hit.t"), late)).alias("_time"),
        F.when(F.col("_fields").isNotNull(), F.coalesce(F.col("_hit.n"), F.lit("ingest"))).alias("time_source"),
        over(rest, above).alias("data"),
        settled(F.when(F.col("_fields").isNull(), "json")).alias("reject_reason"),
    )


def json_profile(lines: DataFrame) -> DataFrame:
    """Which fields the lines contain: per key the rows with it and its types."""
    fields = lines.select(F.explode(object_fields(trim_space(F.col("value")))).alias("field", "v"))
    typed = fields.select("field", F.regexp_extract(F.schema_of_variant("v"), r"^\w+", 0).alias("type"))
    # Numbers of different width are one kind of field.
    kind = F.when(F.col("type").isin("BIGINT", "DECIMAL", "DOUBLE"), "NUMBER").otherwise(F.col("type"))
    return typed.groupBy("field", kind.alias("type")).agg(F.count("*").alias("n"))


def json_schema(lines: DataFrame) -> DataFrame:
    """One schema that fits all lines that hold an object and nothing else, as DDL text."""
    text = trim_space(F.col("value"))
    parsed = F.when(object_fields(text).isNotNull(), parse_whole(text))
    return lines.select(parsed.alias("v")).agg(F.schema_of_variant_agg("v").alias("schema"))
