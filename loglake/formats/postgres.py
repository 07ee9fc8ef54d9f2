"""PostgreSQL logs: statements with a duration, continued over tab-led lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.regexes import is_match, line_pattern, matched_text
from loglake.functions.sqltext import sql_fingerprint
from loglake.functions.text import settled
from loglake.functions.times import TimeFormat, unix_millis
from loglake.functions.typing import as_double, type_pg_meta
from loglake.operators.grouping import group_continuations, rejoined
from loglake.operators.lines import empty_fields
from loglake.operators.sampling import sample_entries

# The escapes of log_line_prefix, their field and what their text looks like.
_STAMP = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}[.0-9]* [A-Z]+"
PREFIX_FIELDS = {
    "a": ("application", r"\S+"),
    "u": ("user", r"\S+"),
    "d": ("database", r"\S+"),
    "r": ("host_port", r"\S+"),
    "h": ("host", r"\S+"),
    "p": ("pid", r"\d+"),
    "t": ("timestamp", _STAMP),
    "m": ("timestamp_millis", _STAMP),
    "n": ("timestamp_unix", r"\d+"),
    "i": ("command_tag", r"\S+"),
    "e": ("sql_state", r"\S+"),
    "c": ("session_id", r"\d+"),
    "l": ("session_line_number", r"\d+"),
    "s": ("session_start", _STAMP),
    "v": ("virtual_transaction_id", r"\S+"),
    "x": ("transaction_id", r"\S+"),
}
DEFAULT_PREFIX = "%t [%p-%l] %u@%d"
_HEADER = r"\s*(?P<level>[A-Z0-9]+):\s+duration: (?P<duration>[0-9.]+) ms\s+(?:statement|execute \S+): "
_NUMBERS = ("pid", "session_id", "session_line_number")
_CLOCK = TimeFormat("yyyy-M-d H:m:s[.SSSSSSSSS]", zone_word=True)


def compile_prefix(log_line_prefix: str) -> str:
    """The prefix format as a pattern, read once from left to right."""
    out: list[str] = []
    for piece in re.findall(r"%-?\d*.|[^%]+|%$", log_line_prefix):
        code = piece[-1]
        if not piece.startswith("%") or piece == "%":
            out.append(re.escape(piece).replace("\\ ", " "))
        elif code == "%":
            out.append("%")
        elif code == "q":
            continue
        elif code in PREFIX_FIELDS:
            name, text = PREFIX_FIELDS[code]
            out.append(f"(?P<{name}>{text})")
        else:
            out.append(re.escape(piece))
    return "".join(out)


def postgres_slow_events(
    lines: DataFrame,
    log_line_prefix: str = DEFAULT_PREFIX,
    ingest_time: Column | None = None,
    prefix: str | None = None,
    rate: int = 1,
    seed: int | None = None,
    **sizes: int,
) -> DataFrame:
    """Entries whose first line is a statement with a duration; others are rejected.

    The statement is the rest of the first line and the left-trimmed lines after it,
    joined by one space. Stamps are read as UTC. Statements are sampled before they are read.
    A number of the prefix that fits no BIGINT stays as text in ``extra``.
    """
    pattern = line_pattern("^" + compile_prefix(log_line_prefix or DEFAULT_PREFIX) + _HEADER)
    late = ingest_time if ingest_time is not None else F.lit(None).cast("timestamp")
    entries = rejoined(group_continuations(lines, prefix, **sizes))
    if rate > 1:
        entries = sample_entries(entries, rate, seed).drop("sample_rate")
    first = F.get("lines", F.lit(0))
    captured = entries.withColumn("_cap", pattern.captures(first))
    names = pattern.field_names()

    def field(name: str) -> Column:
        return pattern.field(F.col("_cap"), name)

    times = []
    if "timestamp_unix" in names:
        times.append(unix_millis(field("timestamp_unix")))
    times += [_CLOCK.parse(field(n)) for n in ("timestamp_millis", "timestamp") if n in names]
    head = F.length(matched_text(F.col("_cap")))
    rest = F.transform(F.slice("lines", F.lit(2), F.size("lines")), lambda l: F.ltrim(l, F.lit(" \t")))
    query = F.array_join(F.concat(F.array(F.substring(first, head + 1, F.length(first))), rest), " ")
    plain = [n for n in names if n not in ("level", "duration", "timestamp", "timestamp_millis", "timestamp_unix")]
    too_long = F.col("parts") > 1
    reason = F.when(too_long, "statement too long").when(~is_match(F.col("_cap")), "not a statement")
    unfit = [F.struct(F.lit(n).alias("key"), F.when(type_pg_meta(field(n)).isNull(), field(n)).alias("value")) for n in names if n in _NUMBERS]
    extra = F.map_from_entries(F.filter(F.array(*unfit), lambda e: e["value"] != "")) if unfit else empty_fields()
    read = captured.select(
        "file", "block", "pos",
        F.when(reason.isNotNull(), F.array_join("lines", "\n")).alias("value"),
        F.when(is_match(F.col("_cap")), F.coalesce(*times, late)).alias("_time"),
        as_double(field("duration")).alias("duration"),
        *[(type_pg_meta(field(n)) if n in _NUMBERS else field(n)).alias(n) for n in plain],
        F.when(is_match(F.col("_cap")), query).alias("query"),
        F.when(is_match(F.col("_cap")), extra).alias("extra"),
        settled(reason).alias("reject_reason"),
    )
    if rate > 1:
        read = read.withColumn("sample_rate", F.lit(rate))
    # The log keeps the closing semicolon, and so does the fingerprint.
    return sql_fingerprint(read)
