"""Graph-database request logs: a begin and an end line per request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.functions.text import settled, trim_space, unbracket, unquote
from loglake.functions.times import ISO_LOCAL, TimeFormat, first_time, plain_time
from loglake.functions.typing import as_double, as_long
from loglake.operators.lines import strip_prefix

_STAMPS = (TimeFormat("yyyy-M-d'T'H:m:s[.SSSSSSSSS]'Z'"), ISO_LOCAL)
TOPIC = "{requests}"
PAIR_SECONDS = 600


def arango_requests(
    lines: DataFrame,
    tz: str = "UTC",
    prefix: str | None = None,
) -> DataFrame:
    """DEBUG lines have six fields, other levels ten; other topics are rejected.

    A number that does not parse is NULL.
    """
    cut = strip_prefix(lines.withColumn("value", trim_space(F.col("value"))), prefix)
    words = cut.withColumn("_w", F.split("value", " ", 5))

    def word(i: int) -> Column:
        return F.get("_w", F.lit(i))

    fields = words.withColumn("_f", F.split(word(4), ","))

    def text(i: int) -> Column:
        return unquote(F.get("_f", F.lit(i)))

    begin = word(2) == "DEBUG"
    complete = F.when(begin, F.size("_f") == 6).otherwise(F.size("_f") == 10)
    end = ~begin
    stamp = F.coalesce(plain_time(word(0), tz), first_time(word(0), _STAMPS, tz))
    reason = (
        F.when(F.size("_w") < 5, "words")
        .when(word(3) != TOPIC, "topic")
        .when(~complete, "fields")
        .when(stamp.isNull(), "time")
    )
    return fields.select(
        "file", "block", "pos", "value", "prefix",
        stamp.alias("_time"),
        unbracket(word(1)).alias("pid"),
        word(2).alias("logLevel"),
        word(3).alias("logTopic"),
        text(1).alias("id"),
        text(2).alias("sourceIP"),
        text(3).alias("method"),
        text(4).alias("protocol"),
        F.when(begin, text(5)).otherwise(text(8)).alias("fullURL"),
        F.when(end, as_long(F.get("_f", F.lit(5)))).alias("responseCode"),
        F.when(end, as_long(F.get("_f", F.lit(6)))).alias("reqBodyLen"),
        F.when(end, as_long(F.get("_f", F.lit(7)))).alias("resBodyLen"),
        F.when(end, as_double(F.get("_f", F.lit(9)))).alias("totalTime"),
        settled(reason).alias("reject_reason"),
    )


def pair_requests(events: DataFrame, keys: Sequence[str] = ("file", "id"), bucket_seconds: int = PAIR_SECONDS) -> DataFrame:
    """Begin and end of a request on one row, one row for each use of an id.

    An end belongs to the newest begin of its id before it; an end without one is a row
    of its own. Pass ``keys=("id",)`` where a request may span rotated files.

    Uses are numbered inside time buckets, where an id that holds much of the log has
    bounded groups. A use that begins and ends between others of its bucket is complete. The first
    ends of a bucket, which may belong to an older begin, and its last use, which may go on, are
    the bucket's summary; only these two rows of a bucket meet in the id's order.
    """
    begin = F.col("logLevel") == "DEBUG"
    side = F.when(begin, 0).otherwise(1)
    timed = events.withColumn("_bucket", F.floor(F.unix_seconds("_time") / bucket_seconds))
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_time", side, "file", "block", "pos")
    begun = F.sum(F.when(begin, 1).otherwise(0)).over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = [F.col(c) for c in ("_time", "file", "block", "pos")]
    used = timed.withColumn("_use", begun).groupBy(*keys, "_bucket", "_use").agg(
        F.count_if(begin).alias("n_begin"),
        F.count_if(~begin).alias("n_end"),
        F.min(F.when(begin, F.col("_time"))).alias("begin_time"),
        F.max(F.when(~begin, F.col("_time"))).alias("end_time"),
        F.max(F.struct(*at, "method", "fullURL")).alias("_newest"),
        F.max(F.when(~begin, F.struct(*at, "responseCode", "totalTime"))).alias("_ended"),
    )
    last = F.max("_use").over(Window.partitionBy(*keys, "_bucket"))
    is_open = (F.col("_use") == 0) | (F.col("_use") == last)
    # A complete use is a group of its own, so that one pass serves both and no id gathers its complete uses.
    used = used.withColumn("_alone", F.when(~is_open, F.struct("_bucket", "_use")))
    by_id = Window.partitionBy(*keys, "_alone").orderBy("_bucket", "_use").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = used.withColumn("_use", F.sum(F.col("n_begin")).over(by_id)).groupBy(*keys, "_alone", "_use").agg(
        *[F.sum(c).alias(c) for c in ("n_begin", "n_end")], F.min("begin_time").alias("begin_time"), F.max("end_time").alias("end_time"),
        F.max("_newest").alias("_newest"), F.max("_ended").alias("_ended"))
    told = [F.col("_newest.method"), F.col("_newest.fullURL"), F.col("_ended.responseCode"), F.col("_ended.totalTime")]
    return both.select(*keys, "n_begin", "n_end", "begin_time", "end_time", *told)
