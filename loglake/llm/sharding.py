"""Shards of rows by jump consistent hashing, and gapless places inside each shard.

The first 64 bits of the MD5 digest of a row's key (its id in decimal; a NULL id is the
empty text) start a linear congruential sequence. It names the shard counts at which the
key moves; the last one below the wanted count is its shard. There is no ring table. With
one more shard a key stays or moves into the new one, so appending a shard moves
1 / (n + 1) of the rows and no row between old shards.

The sequence wraps at 2 ** 64. Column arithmetic raises an error where a BIGINT
overflows, so a state is three limbs of 22, 22 and 20 bits, whose products all fit.

Places: in a shard, rows are in the order of the digest of (key, size, checksum). Equal
rows are counted before anything is moved, so neither a key nor a text that many rows hold
makes a large group. The digest's first bits deal the rest to 2 ** 16 blocks a shard; a row's
place is the number of rows in the blocks before its own plus its rank inside. What is
summed in one task is one count per block, whatever the table holds.

Defined cases: a NULL text has no bytes, size 1 and checksum 0, like an empty one. Rows with
a NULL or repeated id share a shard. Rows that agree in id, size and checksum take neighbouring
places. Long texts only pass through a checksum. An empty table gives no row. ``assign``
keeps all columns and writes over those that bear the names it adds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The multiplier and the top 31 bits of the published hash.
MULTIPLIER = 2862933555777941757
TOP = 1 << 31

LOW, HIGH = (1 << 22) - 1, (1 << 20) - 1
FACTORS = (MULTIPLIER & LOW, (MULTIPLIER >> 22) & LOW, MULTIPLIER >> 44)
BLOCK_DIGITS = 4
AT_ONCE = 1 << 12


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a key, 0 .. shards - 1."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    low = F.conv(F.substring(digest, 6, 11), 16, 10).cast("long")
    start = F.struct(
        low.bitwiseAND(LOW).alias("a"), F.shiftright(low, 22).alias("b"),
        F.conv(F.substring(digest, 1, 5), 16, 10).cast("long").alias("c"),
        F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"),
    )

    def walk(state: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, lambda s, _: F.when(s["next"] < shards, _jump(s)).otherwise(s))

    # Few keys take more steps than this; those that do go on until they are through.
    first = walk(start, min(shards, 16 + 4 * math.ceil(math.log(shards + 1))))
    last = F.transform(F.array(first), lambda s: F.when(s["next"] < shards, walk(s, shards)).otherwise(s)["shard"])
    return last[0].cast("int")


def _jump(s: Column) -> Column:
    """The next count of shards at which a key moves."""
    p = s["a"] * FACTORS[0] + 1
    q = s["a"] * FACTORS[1] + s["b"] * FACTORS[0] + F.shiftright(p, 22)
    r = s["a"] * FACTORS[2] + s["b"] * FACTORS[1] + s["c"] * FACTORS[0] + F.shiftright(q, 22)
    b, c = q.bitwiseAND(LOW), r.bitwiseAND(HIGH)
    top = F.shiftleft(c, 11).bitwiseOR(F.shiftright(b, 11))
    reach = F.floor((s["next"] + 1).cast("double") * (F.lit(float(TOP)) / (top + 1).cast("double")))
    return F.struct(p.bitwiseAND(LOW).alias("a"), b.alias("b"), c.alias("c"), s["next"].alias("shard"), reach.alias("next"))


def assign(rows: DataFrame, shards: int, key: str = "doc_id", out: str = "shard", grown: str = "grown_shard") -> DataFrame:
    """The rows with their shard, and the shard they are in once one more is appended. Nothing is moved."""
    at, after = jump_shard(F.col(key), shards), jump_shard(F.col(key), shards + 1)
    return rows.withColumns({out: at, grown: after})


def moved(rows: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """The rows that an appended shard takes: what a job has to copy, and from where."""
    return assign(rows, shards, key).filter("shard <> grown_shard")


def sizes(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the size of their text in bytes, plus one, and its checksum."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return rows.withColumns({"size": F.octet_length(whole).cast("long") + 1, "text_crc32": F.crc32(whole)})


def shard_report(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    counted = sizes(docs.select("doc_id", "text")).groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    mark = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32"))
    dealt = assign(counted, shards).withColumn("mark", mark).withColumn("block", F.substring("mark", 1, BLOCK_DIGITS))

    blocks = dealt.groupBy("shard", "block").agg(F.sum("n").alias("rows_in"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("rows_in").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy("mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("rank", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(starts, ["shard", "block"]).withColumn("first", F.col("start") + F.col("rank"))
    )
    return spread(placed).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long"), "grown_shard")


def spread(placed: DataFrame) -> DataFrame:
    """One row per place of ``first`` .. ``first + n - 1``; many equal rows are dealt out in parts."""
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / AT_ONCE))
    one = placed.filter("n = 1").withColumn("slot", F.col("first"))
    cut = placed.filter("n > 1").withColumn("part", F.explode(parts)).repartition("shard", "first", "part")
    last = F.least(F.col("n"), (F.col("part") + 1) * AT_ONCE) - 1
    many = cut.withColumn("nth", F.explode(F.sequence(F.col("part") * AT_ONCE, last)))
    return one.unionByName(many.withColumn("slot", F.col("first") + F.col("nth")).drop("part", "nth"))


def write_shards(rows: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """The rows under ``shard=k`` folders, in several files where a shard holds much."""
    out = assign(rows, shards, key).drop("grown_shard")
    out.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
