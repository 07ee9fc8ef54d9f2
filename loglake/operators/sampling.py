"""Sampling with weights: every kept row carries ``sample_rate``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.operators.transforms import sample_key
from loglake.session import staged
from loglake.streaming.state import Slots

_HASH_SPAN = 16**8
# A late file may still count for a window this many windows back.
KEPT_WINDOWS = 120


def _one_of(rate: int) -> None:
    if rate < 1:
        raise ValueError("a sample rate is an integer of at least 1")


def sample_lines(lines: DataFrame, rate: int, seed: int | None = None) -> DataFrame:
    """Keep one line of ``rate`` at random. Put it right on the scan: it is not pushed down.

    A filter, so that it also works on a stream.
    """
    _one_of(rate)
    if rate == 1:
        return lines
    return lines.filter(F.rand(seed) < 1.0 / rate)


def sample_entries(entries: DataFrame, rate: int, seed: int | None = None) -> DataFrame:
    """Keep one of ``rate`` whole statements; use it after grouping.

    The rows of a statement in several parts stay or go together, by a hash of its place.
    """
    _one_of(rate)
    if "parts" not in entries.columns:
        return sample_lines(entries, rate, seed).withColumn("sample_rate", F.lit(rate))
    place = F.pmod(F.xxhash64("file", "block", "pos", F.lit(seed or 0)), F.lit(rate)) == 0
    kept = entries.filter(F.when(F.col("parts") == 1, F.rand(seed) < 1.0 / rate).otherwise(place)) if rate > 1 else entries
    return kept.withColumn("sample_rate", F.lit(rate))


def hash_position(key: Column) -> Column:
    """A repeatable number in ``[0, 2^32)`` for a key."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_sample(df: DataFrame, keys: Sequence[str], rate: int) -> DataFrame:
    """Keep the keys whose hash falls into the first ``1/rate`` of the hash range."""
    _one_of(rate)
    key = sample_key([F.col(k) for k in keys])
    return df.filter(hash_position(key) * rate < _HASH_SPAN).withColumn("sample_rate", F.lit(rate))


def window_counts(events: DataFrame, key: Column, seconds: int = 30, time: str = "_time") -> DataFrame:
    """Rows per key and tumbling window, combined before the shuffle."""
    start = (F.floor(F.unix_seconds(time) / seconds) * seconds).cast("bigint")
    return events.groupBy(start.alias("window_start"), key.alias("sample_key")).agg(F.count("*").alias("n"))


def window_rates(counts: DataFrame, goal: int, seconds: int = 30, min_per_second: int = 1) -> DataFrame:
    """Rate per key for the window *after* the one that was counted.

    A quiet window samples nothing. Otherwise the kept budget, total over goal, is
    shared in proportion to ``ln(1 + n)``, so rare keys keep all their rows.
    """
    totals = counts.groupBy("window_start").agg(
        F.sum("n").alias("_total"), F.sum(F.ln(F.col("n") + 1).cast("decimal(20,12)")).alias("_weight")
    )
    share = (F.col("_total") / goal) * F.ln(F.col("n") + 1) / F.col("_weight").cast("double")
    quiet = F.col("_total") < min_per_second * seconds
    # Rounded first, so that float noise cannot push an exact ratio over a whole number.
    rate = F.when(quiet, F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.round(F.col("n") / share, 6))))
    return counts.join(totals, "window_start").select(
        (F.col("window_start") + seconds).alias("window_start"), "sample_key", rate.cast("int").alias("rate")
    )


def dynamic_sample(
    events: DataFrame,
    keys: Sequence[str],
    goal: int,
    seconds: int = 30,
    min_per_second: int = 1,
    row_key: Sequence[str] = ("file", "pos"),
    time: str = "_time",
    memory: Slots | None = None,
) -> DataFrame:
    """Thin frequent keys by the counts of the window before; keep rare ones.

    With a ``memory``, the counts that batches before this one left are added to its own, and the
    sum is left for the next: the first window of a batch gets the rates of the last window of the
    batch before, and a window whose rows come in several batches is counted over all that came.

    A key not seen in that window has rate 1; where that window has no rows at all,
    the rate is ``goal``. Rows without a time are all kept, at rate 1. The join is on window and key: the rate table holds one row
    per pair, and AQE splits a pair with many events. The counts are taken by a job of
    their own and staged, so the events are read twice in all.
    """
    if goal < 2:
        raise ValueError("dynamic sampling needs a goal rate of at least 2")
    start = (F.floor(F.unix_seconds(time) / seconds) * seconds).cast("bigint")
    key = sample_key([F.col(k) for k in keys])
    counts = staged(window_counts(events, key, seconds, time), "window-counts")
    known = counts if memory is None else remembered(counts, memory)
    before = window_rates(known, goal, seconds, min_per_second)
    counted = known.select((F.col("window_start") + seconds).alias("window_start")).distinct().withColumn("_counted", F.lit(True))
    # Settled on the counts, which hold every pair the events have: one join of the events.
    rate = F.coalesce("rate", F.when(F.col("_counted"), F.lit(1)).otherwise(F.lit(goal))).cast("int")
    rates = (
        counts.select("window_start", "sample_key")
        .join(before, ["window_start", "sample_key"], "left").join(counted, "window_start", "left")
        .select("window_start", "sample_key", rate.alias("sample_rate"))
    )
    keyed = events.drop("sample_rate").withColumn("sample_key", key).withColumn("window_start", start)
    # A row without a time has no window and no match: it stays, at rate 1.
    rated = keyed.join(rates, ["window_start", "sample_key"], "left").withColumn("sample_rate", F.coalesce("sample_rate", F.lit(1)))
    spot = hash_position(F.concat_ws("|", *[F.col(k).cast("string") for k in row_key]))
    kept = rated.filter(spot * F.col("sample_rate") < _HASH_SPAN)
    return kept.select(*[c for c in events.columns if c != "sample_rate"], "sample_key", "sample_rate")


def remembered(counts: DataFrame, memory: Slots, windows: int = KEPT_WINDOWS) -> DataFrame:
    """The counts of this batch and of the windows kept from those before; leaves the newest windows to the next."""
    earlier = memory.read()
    both = counts if earlier is None else counts.unionByName(earlier)
    known = both.filter("window_start IS NOT NULL").groupBy("window_start", "sample_key").agg(F.sum("n").alias("n"))
    known = staged(known, "known-counts")
    newest = known.select("window_start").distinct().orderBy(F.col("window_start").desc()).limit(windows)
    memory.write(known.join(newest, "window_start", "left_semi"))
    return known


def weighted_rollup(events: DataFrame, by: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
    """Counts and totals with the weights put back."""
    rate = F.coalesce(F.col("sample_rate"), F.lit(1))
    sums = [F.sum(F.col(m) * rate).alias(f"total_{m}") for m in measures]
    return events.groupBy(*by).agg(F.count("*").alias("kept"), F.sum(rate).alias("n"), *sums)
