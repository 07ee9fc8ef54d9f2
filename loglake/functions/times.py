"""Timestamps out of log text.

Every parse returns NULL on failure; nothing here reads the clock. Stamps without
a zone are read in ``tz``; the session zone must be UTC (``loglake.session``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields that usually hold the time of an event, in probing order.
TIME_FIELDS = (
    "time", "Time", "timestamp", "Timestamp", "TimeStamp",
    "date", "Date", "datetime", "Datetime", "DateTime",
)

NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
UNIX_FORMAT = "%s(%L)?"

# Strftime specifiers and the Spark pattern letters for them.
STRFTIME = {
    "%a": "", "%A": "", "%b": "MMM", "%B": "MMMM", "%h": "MMM",
    "%d": "d", "%e": "d", "%D": "M/d/yy", "%F": "yyyy-M-d",
    "%H": "H", "%k": "H", "%I": "h", "%l": "h", "%m": "M", "%M": "m", "%S": "s",
    "%p": "a", "%P": "a", "%r": "h:m:s a", "%R": "H:m", "%T": "H:m:s",
    "%y": "yy", "%Y": "yyyy", "%z": "xx", "%Z": "", "%f": "", "%L": "",
    "%n": " ", "%t": " ", "%+": "MMM d H:m:s yyyy",
}
# Specifiers without a meaning here.
UNSUPPORTED = ("%c", "%C", "%E", "%G", "%g", "%j", "%O", "%u", "%U", "%V", "%w", "%W", "%x", "%X")

# Layout words by example date, longest first where one starts another.
LAYOUT_WORDS = (
    ("January", "MMMM"), ("Monday", ""), ("2006", "yyyy"), ("-07:00", "xxx"), ("Z07:00", "XXX"),
    ("-0700", "xx"), ("Jan", "MMM"), ("Mon", ""), ("MST", ""), ("01", "M"), ("02", "d"), ("03", "h"),
    ("04", "m"), ("05", "s"), ("06", "yy"), ("15", "H"), ("PM", "a"), ("pm", "a"), ("_2", "d"), ("_3", "h"),
)

_WEEKDAY = r"\b(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s*"
_ZONE_WORD = r"\s*\b[A-Z]{3,5}\b(?=\s|\z)"
_FRACTION = "[.SSSSSSSSS]"


@dataclass(frozen=True)
class TimeFormat:
    """A Spark datetime pattern plus the words to take out of the text before parsing."""

    pattern: str
    weekday: bool = False
    zone_word: bool = False

    @property
    def has_offset(self) -> bool:
        return "xx" in self.pattern or "XX" in self.pattern

    def parse(self, col: Column, tz: str = "UTC") -> Column:
        text = F.replace(col, F.lit("  "), F.lit(" "))
        if self.weekday:
            text = F.regexp_replace(text, _WEEKDAY, "")
        named = text
        if self.zone_word:
            text = F.regexp_replace(text, _ZONE_WORD, "")
        stamp = F.try_to_timestamp(F.btrim(text), F.lit(self.pattern))
        if self.has_offset:
            return stamp
        if not self.zone_word:
            return in_zone(stamp, tz)
        # A zone word is only known where the chosen zone uses it; else it means UTC.
        shift = F.lit(0).cast("bigint")
        for word, seconds in _zone_words(tz).items():
            shift = F.when(named.rlike(rf"\b{word}\b"), F.lit(seconds * 1_000_000).cast("bigint")).otherwise(shift)
        return F.timestamp_micros(F.unix_micros(stamp) - shift)


def _zone_words(tz: str) -> dict[str, int]:
    if tz.upper() == "UTC":
        return {}
    zone = ZoneInfo(tz)
    words = {}
    for month in (1, 7):
        at = datetime(2020, month, 1, tzinfo=zone)
        name = at.tzname() or ""
        if re.fullmatch("[A-Z]{3,5}", name):
            words[name] = int(at.utcoffset().total_seconds())
    return words


def in_zone(stamp: Column, tz: str) -> Column:
    """A stamp read as UTC, moved to the instant it has in ``tz``."""
    return stamp if tz.upper() == "UTC" else F.to_utc_timestamp(stamp, tz)


def to_spark_format(fmt: str) -> TimeFormat:
    """Translate a strftime format, or a layout written as an example date."""
    fmt = fmt.replace(",", ".")
    if "%" in fmt:
        tokens = _strftime_tokens(fmt)
    else:
        tokens = _layout_tokens(fmt)
    pattern, weekday, zone_word = "", False, False
    skip_space = False
    for kind, text in tokens:
        if kind in ("%a", "%A", "Mon", "Monday", "%+"):
            weekday = True
            skip_space = text == ""
        if kind in ("%Z", "MST", "%+"):
            zone_word = True
            pattern = pattern.rstrip(" ")
        if kind == "literal" and skip_space:
            text = text.lstrip(" .")
        if kind in ("%f", "%L"):
            pattern = pattern[:-1] if pattern.endswith(".") else pattern
            if not pattern.endswith(_FRACTION):
                pattern += _FRACTION
            continue
        pattern += _quote(text) if kind == "literal" else text
        if kind == "literal" and text:
            skip_space = False
        if kind in ("%S", "%T", "%r", "%+", "05"):
            pattern = re.sub(r"s(?=( a)?( yyyy)?$)", "s" + _FRACTION, pattern, count=1)
    pattern = pattern.strip(" ")
    if not pattern:
        raise ValueError(f"no time in format {fmt!r}")
    return TimeFormat(pattern, weekday, zone_word)


def _strftime_tokens(fmt: str) -> list[tuple[str, str]]:
    tokens: list[tuple[str, str]] = []
    for piece in re.findall(r"%.|[^%]+|%$", fmt):
        if not piece.startswith("%"):
            tokens.append(("literal", piece))
        elif piece == "%%":
            tokens.append(("literal", "%"))
        elif piece in STRFTIME:
            tokens.append((piece, STRFTIME[piece]))
        else:
            raise ValueError(f"unsupported time specifier {piece!r} in {fmt!r}")
    return tokens


def _layout_tokens(fmt: str) -> list[tuple[str, str]]:
    tokens: list[tuple[str, str]] = []
    i = 0
    while i < len(fmt):
        fraction = re.match(r"\.(?:9+|0+)(?!\d)", fmt[i:])
        if fraction:
            if not (tokens and tokens[-1][0] == "05"):
                tokens.append(("%f", ""))
            i += fraction.end()
            continue
        for word, letters in LAYOUT_WORDS:
            if fmt.startswith(word, i):
                tokens.append((word, letters))
                i += len(word)
                break
        else:
            tokens.append(("literal", fmt[i]))
            i += 1
    return tokens


def _quote(text: str) -> str:
    return re.sub(r"[A-Za-z\[\]{}#]+", lambda m: f"'{m.group(0)}'", text.replace("'", "''"))


# The layouts tried when no format is given or the given one fails.
DEFAULT_FORMATS = (
    TimeFormat("yyyy-M-d H:m:s[.SSSSSSSSS] xx", zone_word=True),
    TimeFormat("yyyy-M-d'T'H:m:s[.SSSSSSSSS]XXX"),
    TimeFormat("MMM d H:m:s[.SSSSSSSSS] xx yyyy", weekday=True),
    TimeFormat("MMM d H:m:s[.SSSSSSSSS] yyyy", weekday=True, zone_word=True),
)

ISO_LOCAL = TimeFormat("yyyy-M-d'T'H:m:s[.SSSSSSSSS]")
ISO_OFFSET = TimeFormat("yyyy-M-d'T'H:m:s[.SSSSSSSSS]xx")


def unix_time(col: Column) -> Column:
    """Epoch seconds, or ``seconds.mmm`` with exactly three digits."""
    text = F.translate(col, ",", ".")
    whole = F.timestamp_seconds(F.when(text.rlike(r"\A[+-]?\d+\z"), text.try_cast("bigint")))
    split = text.rlike(r"\A\d+\.\d{3}\z")
    millis = F.timestamp_millis(F.when(split, F.regexp_replace(text, r"\.", "").try_cast("bigint")))
    return F.coalesce(whole, millis)


def unix_millis(col: Column) -> Column:
    return F.timestamp_millis(F.when(col.rlike(r"\A\d+\z"), col.try_cast("bigint")))


def parse_time(col: Column, fmt: str | None = None, tz: str = "UTC") -> Column:
    """The given format first, then the default layouts; NULL if none fits."""
    text = F.translate(col, ",", ".")
    tries: list[Column] = []
    if fmt == UNIX_FORMAT:
        tries.append(unix_time(text))
    elif fmt:
        tries.append(to_spark_format(fmt).parse(text, tz))
    tries += [f.parse(text, tz) for f in DEFAULT_FORMATS]
    return F.coalesce(*tries)


def time_hits(names: Sequence[str], text_of, fmt: str | None, tz: str) -> Column:
    """The named fields that are there, in order, as ``array<struct<n, t>>``.

    One expression inside a lambda, so the layouts are tried for present fields only.
    """
    every = F.array(*[F.lit(n) for n in names])
    present = F.filter(every, lambda n: text_of(n).isNotNull())
    return F.transform(present, lambda n: F.struct(n.alias("n"), parse_time(text_of(n), fmt, tz).alias("t")))


def resolve_time(
    df: DataFrame,
    ingest_time: Column,
    field: str | None = None,
    fmt: str | None = None,
    tz: str = "UTC",
    fields: str = "_fields",
) -> DataFrame:
    """Take the event time out of a string map: adds ``_time``, ``time_source``, ``data``.

    With ``field`` only that field counts; otherwise the well-known names are tried
    in order, and the one that was used (or tried last) leaves the map; a number that
    is no time stays. What cannot be
    parsed falls back to ``ingest_time``, a column of the caller, so that a second run
    gives the same answer.
    """
    names: Sequence[str] = (field,) if field else TIME_FIELDS
    hits = df.withColumn("_hits", time_hits(names, lambda n: F.element_at(fields, n), fmt, tz))
    hit = hits.withColumn("_hit", F.get(F.filter("_hits", lambda h: h["t"].isNotNull()), F.lit(0)))
    tried = F.try_element_at("_hits", F.lit(-1))["n"]
    number = F.element_at(fields, tried).rlike(NUMBER)
    used = F.coalesce(F.col("_hit.n"), F.when(~number, tried))
    return hit.withColumn("_used", used).select(
        *df.columns,
        F.coalesce(F.col("_hit.t"), ingest_time).alias("_time"),
        F.coalesce(F.col("_hit.n"), F.lit("ingest")).alias("time_source"),
        F.map_filter(fields, lambda k, v: ~k.eqNullSafe(F.col("_used"))).alias("data"),
    )


def infer_year(month_day_time: Column, reference: Column, fmt: TimeFormat, tz: str = "UTC") -> Column:
    """A stamp without year: the year of ``reference`` if that lies in the past, else one before."""
    def in_year(year: Column) -> Column:
        dated = TimeFormat("yyyy " + fmt.pattern, fmt.weekday, fmt.zone_word)
        text = F.regexp_replace(month_day_time, "^" + _WEEKDAY, "")
        return dated.parse(F.concat(year.cast("string"), F.lit(" "), text), tz)

    this_year = in_year(F.year(reference))
    return F.when(this_year < reference, this_year).otherwise(in_year(F.year(reference) - 1))


def combine_time(comment_time: Column, set_seconds: Column) -> Column:
    """Epoch seconds of the SET line with the sub-second part of the comment; else either."""
    both = F.timestamp_micros(
        set_seconds * 1_000_000 + F.pmod(F.unix_micros(comment_time), F.lit(1_000_000))
    )
    has_set = set_seconds > 0
    return (
        F.when(has_set & comment_time.isNotNull(), both)
        .when(comment_time.isNotNull(), comment_time)
        .when(has_set, F.timestamp_seconds(set_seconds))
    )


def time_columns(stamp: Column) -> list[Column]:
    """The three stored time columns: second, date and millisecond of the second."""
    return [
        F.date_trunc("second", stamp).alias("_time"),
        F.to_date(stamp).alias("_date"),
        F.pmod(F.floor(F.unix_micros(stamp) / 1000), F.lit(1000)).cast("int").alias("_ms"),
    ]


PLAIN_RE = r"\A[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z?\z"


def plain_time(col: Column, tz: str = "UTC") -> Column:
    """A whole second in ISO form, which a cast reads much faster than a layout does; NULL for anything else."""
    return F.when(col.rlike(PLAIN_RE), in_zone(F.substring(col, 1, 19).try_cast("timestamp"), tz))


def first_time(col: Column, formats: Sequence[TimeFormat], tz: str = "UTC") -> Column:
    return reduce(lambda a, b: F.coalesce(a, b), [f.parse(col, tz) for f in formats])
