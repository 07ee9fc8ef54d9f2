"""The trie of what conversations share at their beginnings, by union-find over sorted neighbours.

A turn is a digest of its role and text; a conversation is the array of its digests. Equal
conversations are one class. Classes are dealt by range of their arrays and sorted, so those
that share a beginning stand side by side and the longest common prefix (LCP) of any two is
the least LCP of the neighbours between them.

1. Blocks. Each partition is read in order and cut into blocks of a bounded size. The edges
   between neighbours of a block are taken in descending depth. Every class begins as a
   component at its own depth; an edge of depth d raises the components on both sides to d,
   writing a node for each depth passed, and merges them: the branching node of depth d.
2. Contraction. Nodes that may go on in a neighbouring block lie on the path of the
   block's first or last class, no deeper than the LCP across that border. Only these
   carry a key, the digest of their prefix. All other nodes are complete.
3. Merge across borders. Open nodes with the same key are added up. That is exact since all
   sums are over members (conversations) or over nodes counted in the block where they
   begin: a child, its text, and a leaf each belong to one block. Children of open nodes
   fetch their parent's smallest member through (block, key), so a root with a
   third of all children makes no large join group.

Borders between partitions need one number each: the LCP of the last and the next first class.
These numbers, one per partition, are all that the driver sees.

Defined cases: turns are in the order of ``turn`` (NULL first), equal ones by the digest of role
and text; repeated rows are turns of their own. NULL roles and texts are empty. Rows without a
conversation id belong to no conversation. An empty table has no node. Long texts only pass through
digests; a conversation has to fit in a row, with 40 bytes a turn. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAMILY, MOST_SHARED = 100, 6
BLOCK_CLASSES, BLOCK_TURNS = 4096, 1 << 16
NO_BORDER = -1

_NODE = (
    "block long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends string, key string, parent_conv_id long, parent_key string"
)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq) with the turns of each conversation in order: (turn, digest, code points)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    one = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("mark"),
        F.length(text).alias("points"))
    return one.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "mark", "points"))).alias("seq"))


def rebuilt(conversations: DataFrame, family: int = FAMILY, most: int = MOST_SHARED) -> DataFrame:
    """(conv_id, id, marks, points) of every conversation after it took its family's beginning."""
    own = turns(conversations)
    shared = F.crc32(F.col("conv_id").cast("string")) % most
    first = own.select(F.col("conv_id").alias("base"), F.slice("seq", 1, most).alias("first"))
    placed = own.withColumns({"h": shared.cast("int"), "base": F.col("conv_id") - F.col("conv_id") % family})
    head = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.slice("seq", 1, 0))
    tail = F.slice("seq", F.col("h") + 1, F.size("seq"))
    whole = placed.join(first, "base", "left").select("conv_id", F.concat(head, tail).alias("seq"))
    marks = F.transform("seq", lambda t: t["mark"])
    return whole.select(
        "conv_id", F.md5(F.array_join(marks, "")).alias("id"), marks.alias("marks"), F.transform("seq", lambda t: t["points"]).alias("points"))


def prefix_nodes(sequences: DataFrame) -> DataFrame:
    """All nodes of the trie of ``sequences(conv_id, id, marks, points)``, each with its smallest member, its
    depth, its parent's smallest member, and the counts of its members, children, leaves and saved tokens."""
    nodes = staged(forests(staged(sorted_classes(sequences), "trie-classes")), "trie-nodes")
    counts = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    is_open = F.col("key").isNotNull()
    merged = staged(
        nodes.filter(is_open).groupBy("key").agg(
            F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in counts],
            F.max("ends").alias("ends"), F.max("parent_key").alias("parent_key")),
        "trie-borders")
    head = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_head"))
    across = merged.join(head, "parent_key", "left").withColumn("parent_conv_id", F.col("_head"))
    # One row per block and open node: no more children meet it than the block has.
    of_block = nodes.filter(is_open).select("block", F.col("key").alias("parent_key")).join(head, "parent_key")
    inside = nodes.filter(~is_open & F.col("parent_key").isNull())
    under = nodes.filter(~is_open & F.col("parent_key").isNotNull()).drop("parent_conv_id").join(of_block, ["block", "parent_key"])
    out = ["conv_id", "depth", "parent_conv_id", *counts, "ends"]
    return inside.select(out).unionByName(under.withColumnRenamed("_head", "parent_conv_id").select(out)).unionByName(across.select(out))


def trie_report(conversations: DataFrame) -> DataFrame:
    """Every node with the digest of the members that end in it."""
    sequences = staged(rebuilt(conversations), "trie-sequences")
    ends = member_digests(sequences).withColumnRenamed("id", "ends")
    nodes = prefix_nodes(sequences).join(ends, "ends", "left")
    return nodes.drop("ends").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


def sorted_classes(sequences: DataFrame) -> DataFrame:
    """One row per distinct sequence, dealt by range and numbered by its partition."""
    classes = sequences.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("marks").alias("marks"), F.first("points").alias("points"))
    return classes.repartitionByRange("marks").withColumn("part", F.spark_partition_id())


def shared_length(a: Column, b: Column) -> Column:
    """Number of equal leading elements of two arrays."""
    least = F.least(F.size(a), F.size(b))
    differ = F.array_min(F.filter(F.sequence(F.lit(0), least), lambda i: (i < least) & (F.get(a, i) != F.get(b, i))))
    return F.coalesce(differ, least)


def borders(classes: DataFrame) -> dict[int, tuple[int, int]]:
    """LCP of each partition with the one before and the one after it; two numbers a partition."""
    ends = classes.groupBy("part").agg(F.min("marks").alias("low"), F.max("marks").alias("high"))
    before = F.lag("high").over(Window.orderBy("part"))
    rows = ends.withColumn("before", before).select("part", F.when(F.col("before").isNotNull(), shared_length(F.col("before"), F.col("low"))).alias("n"))
    left = sorted((r.part, NO_BORDER if r.n is None else r.n) for r in rows.collect())
    after = [n for _, n in left[1:]] + [NO_BORDER]
    return {part: (n, following) for (part, n), following in zip(left, after, strict=False)}


def forests(classes: DataFrame, block_classes: int = BLOCK_CLASSES, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The nodes of all blocks; those that may go on in another block have a key."""
    at_border = borders(classes)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_blocks(batches, at_border, block_classes, block_turns))

    in_order = classes.repartition("part").sortWithinPartitions("part", "marks")
    return in_order.select("part", "marks", "points", "conv_id", "n", "id").mapInArrow(build, _NODE)


@dataclass
class Block:
    """Classes in order, with the LCP to the class before and after the block."""

    number: int
    left: int
    marks: list[list[str]] = field(default_factory=list)
    points: list[list[int]] = field(default_factory=list)
    conv: list[int] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    ids: list[str] = field(default_factory=list)
    lcp: list[int] = field(default_factory=list)  # of each class with the one before it in the block
    turns: int = 0
    right: int = NO_BORDER


def _shared(a: list[str], b: list[str]) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _blocks(batches: Iterator[pa.RecordBatch], at_border: dict, most: int, most_turns: int) -> Iterator[Block]:
    block, part = None, None
    for batch in batches:
        for new_part, marks, points, conv, n, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block is not None and new_part != part:
                block.right = at_border[part][1]
                yield block
                block = None
            if block is None:
                part, block = new_part, Block(new_part << 32, at_border[new_part][0])
            elif len(block.ids) >= most or block.turns >= most_turns:
                block.right = _shared(block.marks[-1], marks)
                yield block
                block = Block(block.number + 1, block.right)
            block.lcp.append(_shared(block.marks[-1], marks) if block.marks else NO_BORDER)
            for column, value in ((block.marks, marks), (block.points, points), (block.conv, conv), (block.n, n), (block.ids, name)):
                column.append(value)
            block.turns += len(marks)
    if block is not None:
        block.right = at_border[part][1]
        yield block


def _prefix_keys(marks: list[str], depth: int) -> list[str]:
    """Digests of the first 0 .. depth marks; the digest of all of them is the sequence's id."""
    sums = hashlib.md5()
    out = [sums.hexdigest()]
    for mark in marks[:depth]:
        sums.update(mark.encode())
        out.append(sums.hexdigest())
    return out


def forest(block: Block) -> list[list]:
    """Nodes of one block: its edges in descending depth, each merge a branching node."""
    size = len(block.ids)
    left_keys, right_keys = _prefix_keys(block.marks[0], block.left), _prefix_keys(block.marks[-1], block.right)
    root = list(range(size))
    low, high = list(range(size)), list(range(size))
    depth = [len(m) for m in block.marks]
    members, smallest = list(block.n), list(block.conv)
    children, below, ends = [0] * size, [0] * size, list(block.ids)
    # A class is a leaf unless the next one goes on from it.
    follow = [*block.lcp[1:], block.right]
    leaves = [int(follow[i] < depth[i]) for i in range(size)]
    waiting: list[list[int]] = [[] for _ in range(size)]  # written nodes that wait for this component's member
    out: list[list] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def key_of(c: int, d: int) -> str | None:
        if low[c] == 0 and d <= block.left:
            return left_keys[d]
        if high[c] == size - 1 and d <= block.right:
            return right_keys[d]
        return None

    def begins(c: int, d: int) -> int:
        return int(not (low[c] == 0 and d <= block.left))

    def raise_to(c: int, d: int) -> None:
        """Write the nodes of a component from its depth up to d + 1; it then is a child at d."""
        points = block.points[low[c]]
        while depth[c] > d:
            k = depth[c]
            key = key_of(c, k)
            if k:
                below[c] += (members[c] - begins(c, k)) * points[k - 1]
            for child in waiting[c]:
                if key is None:
                    out[child][9] = smallest[c]
                else:
                    out[child][10] = key
            waiting[c] = [len(out)]
            out.append([block.number, k, smallest[c], members[c], children[c], leaves[c], below[c], ends[c], key, None, None])
            children[c], ends[c], depth[c] = begins(c, k), None, k - 1

    for edge in sorted(range(1, size), key=lambda i: -block.lcp[i]):
        d, a, b = block.lcp[edge], find(edge - 1), find(edge)
        raise_to(a, d)
        raise_to(b, d)
        if len(waiting[a]) < len(waiting[b]):
            keep, gone = b, a
        else:
            keep, gone = a, b
        waiting[keep].extend(waiting[gone])
        waiting[gone] = []
        root[gone] = keep
        low[keep], high[keep] = min(low[a], low[b]), max(high[a], high[b])
        members[keep], smallest[keep] = members[a] + members[b], min(smallest[a], smallest[b])
        children[keep], leaves[keep], below[keep] = children[a] + children[b], leaves[a] + leaves[b], below[a] + below[b]
        ends[keep] = ends[a] or ends[b]
    raise_to(find(0), NO_BORDER)
    return out


def _batches(blocks: Iterator[Block]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 7 + [pa.string(), pa.string(), pa.int64(), pa.string()]
    names = [part.split()[0] for part in _NODE.split(", ")]
    for block in blocks:
        columns = zip(*forest(block), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def member_digests(sequences: DataFrame) -> DataFrame:
    """(id, ends_sha256): SHA-256 of the members' ids, ascending, with commas between.

    Ids are joined to texts of a batch each, in parallel, also those of one sequence; then
    the texts of a sequence pass through the digest one after another.
    """
    by_range = sequences.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    texts = by_range.mapInArrow(_join_ids, "id string, at long, ids string")
    return texts.repartition("id").sortWithinPartitions("id", "at").mapInArrow(_digests, "id string, ends_sha256 string")


def _runs(column: pa.Array) -> list[int]:
    """Where runs of equal neighbours begin, and the end."""
    if len(column) < 2:
        return [0, len(column)] if len(column) else [0]
    new = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return [0, *(new.nonzero()[0] + 1).tolist(), len(column)]


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = _runs(batch.column(0))
        words = batch.column(1).cast(pa.string()).to_pylist()
        heads = pa.array(at[:-1], pa.int64())
        texts = [",".join(words[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(heads), batch.column(1).take(heads), pa.array(texts, pa.string())], names=["id", "at", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, sums = None, None
    for batch in batches:
        names, digests = [], []
        for new, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if new != name:
                if name is not None:
                    names.append(name)
                    digests.append(sums.hexdigest())
                name, sums = new, hashlib.sha256(ids.encode())
            else:
                sums.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(digests, pa.string())], names=["id", "ends_sha256"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sums.hexdigest()])], names=["id", "ends_sha256"])
