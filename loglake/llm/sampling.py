"""A bounded sample of labelled rows, and the rows kept out of every fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(rows: DataFrame, label: str, total: int, seed: int) -> DataFrame:
    """About ``total`` rows, as many of each label as there are, chosen by a hash of the id.

    ``rows`` holds doc_id and the label. Rows without either, and held-out rows, are left out.
    The share of each label follows from its count, so the expected size is the bound.
    """
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    each = max(1, total // max(1, len(counts)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30))
    share = F.lit(0)
    for value, n in sorted(counts.items()):
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1 << 30, (each << 30) // n))).otherwise(share)
    return rows.filter(draw < share)
