"""Exact quantiles per group without gathering a group's values anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_floor(value: Column, bits: int = 10) -> Column:
    """The value with only its top ``bits + 1`` binary digits kept."""
    width = F.greatest(F.lit(0), F.floor(F.log2(F.greatest(value, F.lit(1)))).cast("int") - bits)
    # shiftright and shiftleft take a constant; a power of two does the same.
    unit = F.pow(F.lit(2.0), width).cast("bigint")
    return value - F.pmod(value, unit)


def value_counts(df: DataFrame, keys: Sequence[str], value: str, count: Column | None = None) -> DataFrame:
    """Rows per key and distinct value as ``(keys, value, n)``, combined before the shuffle."""
    n = F.count("*") if count is None else F.sum(count)
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("n"))


def exact_quantile(counts: DataFrame, keys: Sequence[str], value: str, permille: int, out: str) -> DataFrame:
    """The smallest value with at least ``permille``/1000 of a group's rows at or below it.

    ``counts`` is the result of ``value_counts`` with a non-negative BIGINT value. It is
    first summed per bucket of near values; the histogram of a group is bounded, and
    only the values of the one bucket that holds the rank are looked at singly.
    """
    counts = counts.select(*keys, F.col(value).alias("_v"), F.col("n").alias("_n")).withColumn(
        "_bucket", bucket_floor(F.col("_v"))
    )
    histogram = counts.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_bn"))
    by_key = Window.partitionBy(*keys)
    up_to = by_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = histogram.select(
        *keys, "_bucket", "_bn",
        F.sum("_bn").over(up_to).alias("_upto"),
        F.expr(f"(sum(_bn) OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)}) * {permille} + 999) div 1000").alias("_rank"),
    )
    hit = ranked.filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_bn") < F.col("_rank")))
    chosen = hit.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"),
                        (F.col("_rank") - (F.col("_upto") - F.col("_bn"))).alias("_rest"))
    same = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    near = counts.join(chosen, same)
    in_bucket = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = near.withColumn("_seen", F.sum("_n").over(in_bucket)).filter(F.col("_seen") >= F.col("_rest"))
    return reached.groupBy(*keys).agg(F.min("_v").alias(out))
