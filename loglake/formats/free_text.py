"""Free text read with a list of patterns; the first that matches wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.regexes import PatternError, require_named
from loglake.functions.text import settled
from loglake.functions.times import resolve_time
from loglake.operators.lines import empty_fields, over, strip_prefix


def regex_events(
    lines: DataFrame,
    patterns: Sequence[str],
    ingest_time: Column | None = None,
    time_field: str | None = None,
    time_format: str | None = None,
    tz: str = "UTC",
    prefix: str | None = None,
) -> DataFrame:
    """Named groups of the first match as ``data MAP<STRING, STRING>``.

    Lines are not trimmed. A line without match is rejected unless its prefix gave fields.
    """
    if not patterns:
        raise PatternError("at least one pattern is needed")
    compiled = [require_named(p) for p in patterns]
    late = ingest_time if ingest_time is not None else F.lit(None).cast("timestamp")
    cut = strip_prefix(lines, prefix)

    def tagged(number: int) -> Column:
        # The array lambda names the captures, so each pattern runs once per line.
        captures = F.array(compiled[number].captures(F.col("value")))
        marked = F.transform(captures, lambda c: F.when(F.size(c) > 1, F.concat(F.array(F.lit(str(number))), c)))
        return F.get(marked, F.lit(0))

    chosen = cut.withColumn("_cap", F.coalesce(*[tagged(i) for i in range(len(compiled))]))
    fields = None
    for i, pattern in enumerate(compiled):
        pairs: list[Column] = []
        for name in pattern.field_names():
            pairs += [F.lit(name), F.get("_cap", F.lit(pattern.index(name) + 1))]
        here = F.get("_cap", F.lit(0)) == str(i)
        fields = F.when(here, F.create_map(*pairs)) if fields is None else fields.when(here, F.create_map(*pairs))
    found = chosen.withColumn("_fields", over(F.coalesce(fields, empty_fields()), F.col("prefix")))
    judged = found.withColumn("reject_reason", settled(F.when(F.size("_fields") == 0, "no match")))
    timed = resolve_time(judged, late, time_field, time_format, tz)
    return timed.select("file", "block", "pos", "value", "_time", "time_source", "data", "reject_reason")
