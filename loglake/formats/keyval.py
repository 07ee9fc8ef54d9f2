"""Lines of ``key=value``, ``key="quoted value"`` and bare ``key``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.text import last_wins, settled, trim_space
from loglake.functions.times import resolve_time
from loglake.operators.lines import filter_lines, has_content, over, strip_prefix

_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_PAIR = rf'([^\s="]++)(?:=({_QUOTED}|[^\s"]*+))?'


def _unescape(raw: Column) -> Column:
    inner = F.substring(raw, F.lit(2), F.length(raw) - 2)
    lines = F.regexp_replace(inner, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    tabs = F.regexp_replace(lines, r"(?<!\\)((?:\\\\)*)\\t", "$1\t")
    return F.when(raw.startswith('"'), F.regexp_replace(tabs, r"\\(.)", "$1")).otherwise(raw)


def keyval_fields(text: Column) -> Column:
    """The pairs of a line as a map; the last value of a repeated key wins."""
    keys = F.regexp_extract_all(text, F.lit(_PAIR), F.lit(1))
    values = F.transform(F.regexp_extract_all(text, F.lit(_PAIR), F.lit(2)), _unescape)
    pairs = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, values)).otherwise(last_wins(pairs))


def open_quote(text: Column) -> Column:
    """True if a double quote is left over once all quoted values are taken out."""
    return F.regexp_replace(text, _QUOTED, "").contains('"')


def keyval_events(
    lines: DataFrame,
    ingest_time: Column | None = None,
    time_field: str | None = None,
    time_format: str | None = None,
    tz: str = "UTC",
    prefix: str | None = None,
    filter_regex: str | None = None,
    invert_filter: bool = False,
) -> DataFrame:
    """Events with ``data MAP<STRING, STRING>``; type values with ``typeify_keyval``."""
    late = ingest_time if ingest_time is not None else F.lit(None).cast("timestamp")
    trimmed = lines.withColumn("value", trim_space(F.col("value")))
    if filter_regex:
        trimmed = filter_lines(trimmed, filter_regex, invert_filter)
    fields = strip_prefix(trimmed, prefix).withColumn("_fields", keyval_fields(F.col("value")))
    reason = (
        F.when(open_quote(F.col("value")), "quote")
        .when(F.size("_fields") == 0, "no fields")
        .when(~has_content(F.col("_fields")), "empty")
    )
    judged = fields.withColumn("reject_reason", settled(reason)).withColumn("_fields", over(F.col("_fields"), F.col("prefix")))
    timed = resolve_time(judged, late, time_field, time_format, tz)
    return timed.select("file", "block", "pos", "value", "_time", "time_source", "data", "reject_reason")
