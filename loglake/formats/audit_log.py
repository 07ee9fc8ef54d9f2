"""Database audit logs: JSON with all fields under ``audit_record``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.documents import parse_whole
from loglake.functions.text import settled, trim_space
from loglake.functions.times import TimeFormat
from loglake.operators.lines import filter_lines, over, strip_prefix
from loglake.schemas import MYSQL_AUDIT

_STAMP = TimeFormat("yyyy-M-d'T'H:m:s", zone_word=True)


def mysql_audit_events(
    lines: DataFrame,
    ingest_time: Column | None = None,
    tz: str = "UTC",
    prefix: str | None = None,
    filter_regex: str | None = None,
    invert_filter: bool = False,
) -> DataFrame:
    """Columns of the audit table, other fields in ``extra``; no record or time: rejected."""
    trimmed = lines.withColumn("value", trim_space(F.col("value")))
    if filter_regex:
        trimmed = filter_lines(trimmed, filter_regex, invert_filter)
    cut = strip_prefix(trimmed, prefix).withColumn("_doc", parse_whole(F.col("value")))
    record = F.try_variant_get(F.col("_doc"), "$.audit_record", "map<string,variant>")
    texts = F.transform_values(
        F.map_filter("_record", lambda k, v: v.isNotNull() & ~F.is_variant_null(v)),
        lambda k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)),
    )
    read = cut.withColumn("_record", record).withColumn("_texts", texts)
    # Names are matched as written: the startup options of the log have no other spelling.
    fields = [
        F.coalesce(F.element_at("prefix", F.lit(n)), F.element_at("_texts", F.lit(n))).try_cast(t).alias(n)
        for n, t in MYSQL_AUDIT.payload
    ]
    known = [n for n, _ in MYSQL_AUDIT.payload] + ["timestamp"]
    stamp = _STAMP.parse(F.element_at("_texts", F.lit("timestamp")), tz)
    reason = (
        F.when(F.col("_doc").isNull(), "json")
        .when(F.col("_record").isNull(), "record")
        .when(~F.exists(F.map_values("_texts"), lambda v: v != ""), "empty")
        .when(stamp.isNull(), "time")
    )
    return read.select(
        "file", "block", "pos", "value",
        stamp.alias("_time"), *fields,
        over(
            F.coalesce(F.map_filter("_texts", lambda k, v: ~k.isin(*known)), F.create_map().cast("map<string,string>")),
            F.coalesce(F.map_filter("prefix", lambda k, v: ~k.isin(*known) & v.isNotNull()), F.create_map().cast("map<string,string>")),
        ).alias("extra") if prefix else F.map_filter("_texts", lambda k, v: ~k.isin(*known)).alias("extra"),
        settled(reason).alias("reject_reason"),
    )
