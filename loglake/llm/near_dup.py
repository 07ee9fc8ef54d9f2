"""MinHash near-duplicates with b-bit signatures.

A document is the set of its distinct word shingles. Each set gets ``HASHES`` minima;
``BANDS`` bands of ``ROWS`` full minima make candidate buckets, and the lowest ``BITS`` bits of all
mixed minima, packed into longs, give a similarity estimate by counting bits, corrected for
the chance that two different minima share their low bits. The minima are mixed before the
bits are taken: the low bits of the images themselves differ in all lanes or in none. Pairs
above the estimate's bound are confirmed on the full sets; so are, in every bucket, all pairs of sets of at most
``SMALL_SET`` shingles, of sizes that can be similar.

Equal sets are one class before any pairing, so copies make no pairs. A class is named by its
smallest doc_id; where several classes have the same one, as rows share a doc_id and differ in text, by a
hash of its set. At the end a component takes the smallest doc_id of its classes. Inside a bucket, members are first compared with one leader only. What that leaves apart is compared
more when their estimate is high, and at last every pair of a bucket that is still in two
components is compared; a pair that shares several bands is made in the first of them only.
In large buckets a pair is left out only if it cannot be similar:
shingles that no other set has bound what two sets can share. So no candidate link
between components is lost, while a large group of near copies is mostly joined by its
leaders.

At a similarity of 0.8 a pair misses all bands with probability 7e-6 and falls below the
bound of the estimate, 4 standard deviations below, with one of 3e-5.

Defined cases: a NULL or wordless text has no shingles and links with nothing; a NULL
doc_id links with nothing either, its component is NULL and it is kept. Rows of one
doc_id are rows of their own with the same name. Very long texts are read whole, in slices. An empty table
gives no row. Other columns are not looked at; ``keep_one`` returns them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.arrays import LOWER, SPACE, mix, shingles, span_hashes, text_slices, word_spans
from loglake.llm.graph import components
from loglake.session import staged, with_setting

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS, BANDS, BITS = 5, 30, 2
SMALL_BUCKET = 64
BLOCK = 512
SMALL_SET = 16
SETS_AT_ONCE = 500
MARK_BITS = 1 << 25
HASHES = 256
LANES = 64 // BITS
LONGS = -(-HASHES // LANES)
DEVIATIONS = 4.0

_draw = np.random.default_rng(9)
MASKS = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint32)
FACTORS = _draw.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
BAND_FACTORS = _draw.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNATURE = "doc_id long, text_hash long, n_shingles long, s1 long, s2 long, bits array<long>, bands array<long>"


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of every row."""
    known: dict[int, np.ndarray] = {}
    for first, data, offsets in text_slices(column):
        data = LOWER[data]
        starts, ends, rows = word_spans(~SPACE[data], offsets)
        words = span_hashes(data, starts, ends, known)
        hashes, at = shingles(words, rows, len(offsets) - 1, size)
        for k in range(len(offsets) - 1):
            yield first + k, np.unique(hashes[at[k] : at[k + 1]])


def minima(hashes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The smallest image of the set under each permutation; ``room`` is working space."""
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    step = room.shape[1]
    for k in range(0, len(short), step):
        part = short[k : k + step]
        images = room[:, : len(part)]
        np.bitwise_xor(part[None, :], MASKS[:, None], out=images)
        np.multiply(images, FACTORS[:, None], out=images)
        np.minimum(out, images.min(axis=1), out=out)
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of all minima, mixed, ``LANES`` of them in a long."""
    lanes = np.zeros(LONGS * LANES, dtype=np.uint64)
    lanes[:HASHES] = mix(low.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    shifts = np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(lanes.reshape(LONGS, LANES) << shifts, axis=1).view(np.int64)


def band_keys(smallest: np.ndarray) -> np.ndarray:
    parts = smallest[: ROWS * BANDS].reshape(BANDS, ROWS).astype(np.uint64) * BAND_FACTORS
    keys = np.bitwise_xor(parts, parts >> np.uint64(29)).sum(axis=1, dtype=np.uint64)
    return (keys * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """One row per document: size and 128-bit hash of its set, packed low bits, band keys."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
        ("bits", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64())),
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = np.empty((HASHES, 128), dtype=np.uint32)
        for batch in batches:
            counts, one, two, bits, bands = [], [], [], [], []
            for _, hashes in shingle_sets(batch.column(2), size):
                counts.append(len(hashes))
                first, second = set_hash(hashes)
                one.append(first), two.append(second)
                if not len(hashes):
                    bits.append(None), bands.append(None)
                    continue
                smallest = minima(hashes, room)
                bits.append(packed(smallest))
                bands.append(band_keys(smallest))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(bits, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(sign, SIGNATURE)


def set_hash(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set; zeros for the empty one."""
    if not len(hashes):
        return 0, 0
    odd = hashes * np.uint64(0xD6E8FEB86659FD93)
    return int(np.bitwise_xor.reduce(odd ^ (odd >> np.uint64(32))).view(np.int64)), int(hashes.sum(dtype=np.uint64).view(np.int64))


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(s1, s2, shingles): the whole set of shingle hashes of every row, and its hash."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, SETS_AT_ONCE) for b in batches for k in range(0, b.num_rows, SETS_AT_ONCE)):
            lengths, values, marks = [0], [], []
            for _, hashes in shingle_sets(batch.column(0), size):
                values.append(hashes.view(np.int64))
                lengths.append(lengths[-1] + len(hashes))
                marks.append(set_hash(hashes))
            flat = np.concatenate(values) if values else np.zeros(0, np.int64)
            sets = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))
            one, two = ([m[k] for m in marks] for k in (0, 1))
            yield pa.record_batch([pa.array(one, pa.int64()), pa.array(two, pa.int64()), sets], names=["s1", "s2", "shingles"])

    return docs.select("text").mapInArrow(make, "s1 long, s2 long, shingles array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: share of equal lanes, without the chance hits."""
    ones = F.lit(sum(1 << (BITS * k) for k in range(LANES)))  # fits a long for two bits and more
    differ = F.lit(0)
    for k in range(LONGS):
        lanes = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        folded = lanes
        for shift in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(lanes, shift))
        differ = differ + F.bit_count(folded.bitwiseAND(ones))
    chance = 2.0**-BITS
    return ((F.lit(1.0) - differ / F.lit(float(HASHES))) - chance) / (1.0 - chance)


def bound(similarity: float) -> float:
    """The estimate that a pair of this similarity hardly ever falls below."""
    chance = 2.0**-BITS
    equal = similarity + (1 - similarity) * chance
    return similarity - DEVIATIONS * (equal * (1 - equal) / HASHES) ** 0.5 / (1 - chance)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets share ``percent`` of their union."""
    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - shared
    return pairs.join(one, "a").join(two, "b").filter(shared * 100 >= union * percent).select("a", "b")


def classes(signed: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: its smallest doc_id ``d`` and its name ``rep``."""
    held = F.struct("bits", "bands")
    sets = (
        signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("s1", "s2", "n_shingles")
        .agg(F.min("doc_id").alias("d"), F.min_by(held, "doc_id").alias("held"))
        .select("d", "s1", "s2", "n_shingles", "held.bits", F.array_sort("held.bands").alias("bands"))
    )
    sets = staged(sets, "near-sets-found")
    # Few doc_ids, if any, stand for several sets.
    several = sets.groupBy("d").agg(F.count("*").alias("n")).filter("n > 1").select("d", F.lit(True).alias("several"))
    name = F.when(F.col("several"), F.xxhash64("s1", "s2", "n_shingles")).otherwise(F.col("d"))
    return sets.join(several, "d", "left").select(name.alias("rep"), "d", "s1", "s2", "n_shingles", "bits", "bands")


def linked(reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component) of every class that is linked with another one."""
    spark = reps.sparkSession
    entries = reps.select("rep", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = staged(entries.join(shared, "key"), "near-members")
    nodes = members.select("rep").distinct()
    wanted = staged(reps.join(nodes, "rep", "left_semi"), "near-wanted")
    texts = texts_of(docs, wanted.select(F.col("d").alias("doc_id")))
    named = full_sets(texts, size).join(wanted.select("rep", "s1", "s2"), ["s1", "s2"])
    sets = staged(named.dropDuplicates(["s1", "s2", "rep"]).select("rep", "shingles"), "near-sets")
    signs = wanted.select("rep", "bits", "n_shingles", "bands")
    close = bound(percent / 100.0)
    parts = spark.createDataFrame([], "node long, component long")
    open_rows = members.select("key", "rep", F.col("rep").alias("component"))
    one = signs.select(F.col("rep").alias("a"), F.col("bits").alias("ba"), F.col("n_shingles").alias("na"))
    two = signs.select(F.col("rep").alias("b"), F.col("bits").alias("bb"), F.col("n_shingles").alias("nb"))
    # First one pair for each member, then the likely pairs that are still apart, at last all that can be close.
    room = None
    for least in (None, percent / 100.0 + 0.04, close):
        if least is None:
            pairs = leader_pairs(open_rows).join(one, "a").join(two, "b")
            pairs = pairs.filter((estimate(F.col("ba"), F.col("bb")) >= close) | small_pair("na", "nb", percent)).select("a", "b")
            pairs = staged(pairs, "near-pairs")
        else:
            sizes = open_rows.groupBy("key").agg(F.count("*").alias("n"))
            sized = open_rows.join(sizes, "key").join(signs, "rep")
            few = sized.filter(F.col("n") <= SMALL_BUCKET).withColumns({"size": F.lit(0), "shared": F.lit(0)})
            many = staged(sized.filter(F.col("n") > SMALL_BUCKET), "near-large")
            if room is None:  # members only leave large buckets, so later rounds need no other bounds
                room = staged(shared_sizes(sets.join(many.select("rep").distinct(), "rep", "left_semi")), "near-shared")
            pairs = all_pairs(few, least, percent).unionByName(all_pairs(many.join(room, "rep"), least, percent, True))
            # Blocks are even. Spark would split both sides of a partition that is larger than others, and read each part many times.
            with with_setting(spark, "spark.sql.adaptive.skewJoin.enabled", "false"):
                pairs = staged(pairs, "near-pairs")
        found = confirmed(pairs, sets, percent)
        # What is joined already goes on as one link from each node to its component.
        links = parts.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(found)
        parts = components(links)
        open_rows = staged(still_open(open_rows, parts), "near-open")
        if open_rows.isEmpty():
            break
    return parts


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents with one of the ``ids``.

    A table of bits, of at most ``MARK_BITS`` whatever the number of ids, tells most other documents before the
    join, so that their texts are not shuffled; what shares a bit by chance falls out in the join. The table is
    bounded, so it is broadcast whatever the session's limit: a join by shuffle would move all texts to it.
    The join with the ids is no semi-join, which Spark would push below the bits.
    """
    mark = lambda: F.pmod(F.xxhash64("doc_id"), F.lit(MARK_BITS))
    marks = ids.select(mark().alias("_mark")).groupBy(F.shiftright("_mark", 15).alias("_bucket"))
    marks = marks.agg(F.bitmap_construct_agg(F.col("_mark").bitwiseAND(F.lit((1 << 15) - 1))).alias("_bits"))
    place = F.col("_mark").bitwiseAND(F.lit((1 << 15) - 1))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1
    told = docs.select(F.col("doc_id").cast("long"), "text").withColumn("_mark", mark()).withColumn("_bucket", F.shiftright("_mark", 15))
    likely = told.join(F.broadcast(marks), "_bucket").filter(bit).select("doc_id", "text")
    return likely.join(ids.distinct(), "doc_id")


def still_open(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    named = members.select("key", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("key", "rep", F.coalesce("component", "rep").alias("component"))
    two = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return named.join(two.filter("low < high").select("key"), "key")


def leader_pairs(rows: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's smallest."""
    leaders = rows.groupBy("key").agg(F.min("rep").alias("leader"))
    pairs = rows.join(leaders, "key").filter("rep <> leader")
    return pairs.select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()


def shared_sizes(sets: DataFrame) -> DataFrame:
    """(rep, size, shared): size of each set, and how many of its shingles any other of these sets has.

    Counted the other way round, by the shingles that only one set has, so nothing is joined by shingle.
    """
    tokens = sets.select("rep", F.explode("shingles").alias("token"))
    alone = tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("rep").alias("rep")).filter("df = 1")
    own = alone.groupBy("rep").agg(F.count("*").cast("int").alias("own"))
    sized = sets.select("rep", F.size("shingles").alias("size")).join(own, "rep", "left")
    return sized.select("rep", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("shared")).filter("shared > 0")


def small_pair(a: str, b: str, percent: int) -> Column:
    """Whether two sets of these sizes are small, and near enough in size to be similar."""
    few = F.greatest(a, b)
    return (few <= SMALL_SET) & (F.least(a, b) * 100 >= few * percent)


def all_pairs(rows: DataFrame, least: float, percent: int, blocks: bool = False) -> DataFrame:
    """Pairs of a bucket that lie in two components, are estimated to be close or are small, and have room to be close.

    Two sets can share no more than what each has in common with any set at all. Of the buckets that
    two sets share, all of which are open as long as they are apart, the first makes the pair. With ``blocks``
    a bucket of ``n`` rows is dealt out as pairs of blocks of about ``BLOCK`` rows, each of which can be a task of its own.
    """
    c, on = F.col, ["key"]
    if blocks:
        rows = rows.withColumn("last", F.ceil(c("n") / BLOCK) - 1)
        rows, on = rows.withColumn("block", F.pmod(F.xxhash64("rep"), c("last") + 1)), ["key", "low", "high"]
        one = rows.withColumns({"low": c("block"), "high": F.explode(F.sequence("block", "last"))})
        two = rows.withColumns({"low": F.explode(F.sequence(F.lit(0).cast("long"), "block")), "high": c("block")})
    else:
        one = two = rows
    names = (*on, "rep", "component", "bits", "bands", "n_shingles", "size", "shared")
    one, two = (side.select(*(c(name).alias(f"{name}_{x}") for name in names)) for side, x in ((one, "a"), (two, "b")))
    met = c("rep_a") < c("rep_b")
    if blocks:
        met = met | (c("low_a") < c("high_a"))
    for name in on:
        met = met & (c(f"{name}_a") == c(f"{name}_b"))
    room = F.least("shared_a", "shared_b") * (100 + percent) >= (c("size_a") + c("size_b")) * percent
    near = (c("component_a") != c("component_b")) & room
    likely = (estimate(c("bits_a"), c("bits_b")) >= F.lit(least)) | small_pair("n_shingles_a", "n_shingles_b", percent)
    first = F.array_min(F.array_intersect("bands_a", "bands_b")) == c("key_a")
    pairs = one.join(two, met & near & likely & first)
    return pairs.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``."""
    return marked(docs, size, percent).drop("text_hash")


def marked(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``near_duplicates`` with a hash of the row's text."""
    signed = staged(signatures(docs, size), "near-signatures")
    reps = staged(classes(signed), "near-classes")
    parts = linked(reps, docs, size, percent)
    linked_reps = staged(reps.select("rep", "d").join(parts.withColumnRenamed("node", "rep"), "rep"), "near-parts")
    smallest = linked_reps.groupBy("component").agg(F.min("d").alias("least"))
    of_rep = linked_reps.join(smallest, "component").select("rep", "least")
    named = reps.select("rep", "d", "s1", "s2", "n_shingles").join(of_rep, "rep", "left")
    named = named.select("s1", "s2", "n_shingles", F.coalesce("least", "d").alias("component_id"))
    out = signed.select("doc_id", "text_hash", "n_shingles", "s1", "s2").join(named, ["s1", "s2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without the near copies of others: the smallest doc_id of each group stays.

    Rows that repeat the doc_id that stays, and rows without a doc_id, stay as they are. A row goes by its
    doc_id and text, so a row of another text that has the same doc_id is not taken along.
    """
    gone = marked(docs, size, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone_id"), "text_hash").distinct()
    same = (docs["doc_id"].cast("long") == gone["_gone_id"]) & (F.xxhash64(docs["text"]) == gone["text_hash"])
    return docs.join(gone, same, "left_anti")
