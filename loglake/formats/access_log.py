"""Web access logs described by a format string with ``$variables``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.regexes import PatternError, is_match, line_pattern
from loglake.functions.text import settled, trim_space
from loglake.functions.times import TIME_FIELDS, parse_time
from loglake.functions.typing import as_double, as_long, present
from loglake.operators.lines import strip_prefix

# Variables that hold numbers.
LONG_FIELDS = ("status", "body_bytes_sent", "bytes_sent", "connection", "connection_requests", "request_length", "remote_port")
DOUBLE_FIELDS = ("request_time", "msec", "upstream_response_time")
# Variables that hold the time, with their layout.
TIME_LAYOUTS = {"time_local": "02/Jan/2006:15:04:05 -0700", "time_iso8601": "2006-01-02T15:04:05-07:00"}


def compile_format(log_format: str) -> str:
    """A format string as one pattern: a variable runs up to the character after it."""
    parts = re.split(r"\$\{?([A-Za-z0-9_]+)\}?", log_format.strip())
    if len(parts) < 3:
        raise PatternError(f"no variable in log format {log_format!r}")
    out = ["^", re.escape(parts[0]).replace("\\ ", " ")]
    for name, literal in zip(parts[1::2], parts[2::2]):
        stop = re.escape(literal[0]) if literal else " "
        out.append(f"(?P<{name}>[^{stop}]*)" + re.escape(literal).replace("\\ ", " "))
    return "".join(out)


def access_log_events(
    lines: DataFrame,
    log_format: str,
    ingest_time: Column | None = None,
    time_field: str | None = None,
    time_format: str | None = None,
    tz: str = "UTC",
    prefix: str | None = None,
) -> DataFrame:
    """One column per variable, numbers typed, ``-`` as NULL; prefix fields override."""
    pattern = line_pattern(compile_format(log_format))
    late = ingest_time if ingest_time is not None else F.lit(None).cast("timestamp")
    cut = strip_prefix(lines.withColumn("value", trim_space(F.col("value"))), prefix)
    captured = cut.withColumn("_cap", pattern.captures(F.col("value")))
    texts = {name: present(pattern.field(F.col("_cap"), name)) for name in pattern.field_names()}
    for name in line_pattern(prefix).field_names() if prefix else ():
        over = present(F.element_at("prefix", F.lit(name)))
        texts[name] = F.coalesce(over, texts[name]) if name in texts else over

    if time_field or time_format:
        # A custom time needs both parts; with one alone the line keeps the ingest time.
        clock = {time_field: time_format} if time_field and time_format else {}
    else:
        clock = {n: f for n, f in TIME_LAYOUTS.items() if n in texts}
        clock = dict(list(clock.items())[:1])
    stamp = late
    for name, layout in clock.items():
        if name in texts:
            stamp = F.coalesce(parse_time(texts[name], layout, tz), late)
    if not clock and not time_field and not time_format:
        # Without a clock variable the well-known names count, in their order; such a field stays a field.
        named = [parse_time(texts[n], None, tz) for n in TIME_FIELDS if n in texts]
        stamp = F.coalesce(*named, late) if named else late
    fields = [_typed(n, c).alias(n) for n, c in texts.items() if n not in clock]
    return captured.select(
        "file", "block", "pos", "value",
        F.when(is_match(F.col("_cap")), stamp).alias("_time"),
        *fields,
        unfitting(texts).alias("extra"),
        settled(F.when(~is_match(F.col("_cap")), "format")).alias("reject_reason"),
    )


def unfitting(texts: dict[str, Column]) -> Column:
    """The texts of number fields that are no numbers, by name."""
    kept = [
        F.struct(F.lit(n).alias("key"), F.when(_typed(n, c).isNull(), c).alias("value"))
        for n, c in texts.items() if n in LONG_FIELDS or n in DOUBLE_FIELDS
    ]
    if not kept:
        return F.create_map().cast("map<string,string>")
    return F.map_from_entries(F.filter(F.array(*kept), lambda e: e["value"].isNotNull()))


def _typed(name: str, text: Column) -> Column:
    if name in LONG_FIELDS:
        return as_long(text)
    if name in DOUBLE_FIELDS:
        return as_double(text)
    return text
