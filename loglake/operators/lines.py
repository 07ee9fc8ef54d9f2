"""Operators on lines before and right after parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.regexes import is_match, line_pattern, matched_text
from loglake.functions.text import trim_space

EMPTY_MAP = "map<string,string>"


def empty_fields() -> Column:
    return F.create_map().cast(EMPTY_MAP)


def filter_lines(lines: DataFrame, regex: str, invert: bool = False) -> DataFrame:
    """Keep lines that match, or with ``invert`` those that do not. Runs before the prefix is cut."""
    hit = line_pattern(regex).matches(F.col("value"))
    return lines.filter(~hit if invert else hit)


def trim_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("value", trim_space(F.col("value")))


def strip_prefix(lines: DataFrame, regex: str | None) -> DataFrame:
    """Cut a leading match off the line; its named groups go to the map ``prefix``."""
    if not regex:
        return lines.withColumn("prefix", empty_fields())
    pattern = line_pattern(regex if regex.startswith("^") else "^" + regex)
    captured = lines.withColumn("_cap", pattern.captures(F.col("value")))
    found = is_match(F.col("_cap"))
    head = F.length(matched_text(F.col("_cap")))
    cut = F.when(found, F.substring("value", head + 1, F.length("value"))).otherwise(F.col("value"))
    return captured.select(
        *[c for c in lines.columns if c != "value"],
        cut.alias("value"),
        F.coalesce(pattern.as_map(F.col("_cap")), empty_fields()).alias("prefix"),
    )


def merge_prefix(events: DataFrame, data: str = "data", prefix: str = "prefix") -> DataFrame:
    """Prefix fields override parsed fields of the same name."""
    return events.withColumn(data, over(F.col(data), F.col(prefix)))


def over(below: Column, above: Column) -> Column:
    """Map union where ``above`` wins, whatever the session says about duplicate keys."""
    kept = F.map_filter(below, lambda k, v: ~F.map_contains_key(above, k))
    return F.when(F.size(above) == 0, below).otherwise(F.map_concat(kept, above))


def has_content(data: Column) -> Column:
    """True unless the map is empty or holds empty strings only."""
    return F.exists(F.map_values(data), lambda v: v != "")


def drop_empty(events: DataFrame, data: str = "data") -> DataFrame:
    return events.filter(has_content(F.col(data)))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events, and the lines that did not parse with the reason.

    Both are filters over one parse. To store both in one pass use ``write_outcome``.
    """
    events = parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = parsed.filter(F.col("reject_reason").isNotNull()).select("file", "pos", "value", "reject_reason")
    return events, rejects
