"""Exact top-k inner products by sorted lists, without random access.

Each dimension of a block of candidates is a list sorted by value. The lists are read
in step from both ends: from the large end for queries with a positive component, from the small end
for a negative one. What has been read bounds every candidate's score: unread components
lie between the list's far end (lower bound) and the place reached (upper bound). A query stops
as soon as no candidate outside its k best lower bounds has an upper bound that reaches the
k-th lower bound; then only candidates whose upper bound reaches it are resolved to
final scores. So the result is exact, ties included, whatever the data.

Vectors become integers, floor(``scale`` * x). Candidates are dealt into blocks of about
``BLOCK`` rows and queries into blocks of ``QUERIES``, each packed into one row; a task holds one
pair of blocks. Each pair gives k rows a query at most, and the pairs of a query are
merged by rank. Bounds of all queries of a block come from matrix products; sums
that could exceed 2 ** 53 are done in Python integers instead.

Defined cases: vectors that are NULL, empty, hold a NULL, a non-finite component or one
too large for a 64-bit integer take no part, nor do rows without an id. Vectors of other lengths
than the query's are no candidates of it. Rows that share an id are one row for exclusion: a query's own id is
no candidate. Ties go to the smaller id; repeated rows are ranked one after another.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK, QUERIES = 4096, 512
LEVELS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1.0)


def integer_vectors(table: DataFrame, id_name: str, vector_name: str, scale: int) -> DataFrame:
    """(id, v): the vectors that take part, as 64-bit integers."""
    x = F.transform(F.col(vector_name), lambda c: c.cast("double") * F.lit(float(scale)))
    good = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < F.lit(2.0**62)))
    rows = table.filter(F.col(id_name).isNotNull() & F.col(vector_name).isNotNull() & (F.size(vector_name) > 0)).filter(good)
    return rows.select(F.col(id_name).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c).cast("long")).alias("v"))


def packed(rows: DataFrame, size: int, total: int) -> DataFrame:
    """(n, block, ids, values): the vectors of a length, dealt by a hash into blocks of about ``size``."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def out(keys) -> pa.RecordBatch:
            parts = [(k, held.pop(k)) for k in keys]
            return pa.record_batch(
                [pa.array([k[0] for k, _ in parts], pa.int32()), pa.array([k[1] for k, _ in parts], pa.int32()),
                 pa.array([b"".join(p[0] for p in rows) for _, rows in parts], pa.binary()),
                 pa.array([b"".join(p[1] for p in rows) for _, rows in parts], pa.binary())],
                names=["n", "block", "ids", "values"])

        for batch in batches:
            n, block, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            vectors = batch.column(3)
            at = np.append(vectors.offsets.to_numpy(), 0)[: len(n) + 1]
            flat = vectors.values.to_numpy(zero_copy_only=False)
            for key in sorted(set(zip(n.tolist(), block.tolist(), strict=True))):
                which = np.flatnonzero((n == key[0]) & (block == key[1]))
                values = np.stack([flat[at[k] : at[k] + key[0]] for k in which])
                held.setdefault(key, []).append((ids[which].astype("<i8").tobytes(), values.astype("<i8").tobytes()))
                # The partition is sorted by block: what is not the latest is complete.
            done = [k for k in held if k != (int(n[-1]), int(block[-1]))] if len(n) else []
            if done:
                yield out(done)
        if held:
            yield out(list(held))

    blocks = max(1, -(-total // size))
    dealt = rows.select(F.size("v").alias("n"), F.pmod(F.xxhash64("id", F.lit(8)), F.lit(blocks)).cast("int").alias("block"), "id", "v")
    ordered = dealt.repartition(blocks, "n", "block").sortWithinPartitions("n", "block", "id")
    return ordered.mapInArrow(pack, "n int, block int, ids binary, values binary")


def search_block(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int):
    """(query row, id, score) of the best of one block for every query of another; how deep the lists were read."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * c.shape[1] >= 2.0**53:
        q, c = q.astype(object), c.astype(object)
    else:
        q, c = q.astype(np.float64), c.astype(np.float64)
    plus, minus = np.where(q > 0, q, 0), np.where(q < 0, q, 0)
    order = np.argsort(c.astype(np.float64), axis=0, kind="stable")
    lists = np.take_along_axis(c, order, axis=0)
    n = len(c)
    low, high = lists[0], lists[-1]
    # Values read so far from the large and from the small end; what is not read is bounded.
    from_top_low, from_top_high = np.broadcast_to(low, c.shape).copy(), np.broadcast_to(high, c.shape).copy()
    from_end_low, from_end_high = np.broadcast_to(low, c.shape).copy(), np.broadcast_to(high, c.shape).copy()
    live, found, read = np.arange(len(q)), [], 0
    dims = np.arange(c.shape[1])
    for level in LEVELS:
        depth = n if level == 1.0 else max(k + 1, int(n * level))
        if depth <= read and level < 1.0:
            continue
        depth = min(depth, n)
        top, end = order[n - depth : n - read], order[read:depth]
        from_top_low[top, dims] = from_top_high[top, dims] = lists[n - depth : n - read]
        from_end_low[end, dims] = from_end_high[end, dims] = lists[read:depth]
        unread_top = np.ones(c.shape, dtype=bool)
        unread_top[order[n - depth :], dims] = False
        unread_end = np.ones(c.shape, dtype=bool)
        unread_end[order[:depth], dims] = False
        from_top_high[unread_top] = np.broadcast_to(lists[n - depth], c.shape)[unread_top]
        from_end_low[unread_end] = np.broadcast_to(lists[depth - 1], c.shape)[unread_end]
        read = depth
        lower = plus[live] @ from_top_low.T + minus[live] @ from_end_high.T
        upper = plus[live] @ from_top_high.T + minus[live] @ from_end_low.T
        own = query_ids[live][:, None] == ids[None, :]
        lower[own] = upper[own] = -np.inf
        take = min(k, n)
        kth = np.partition(lower.astype(np.float64), n - take, axis=1)[:, n - take]
        reach = upper >= kth[:, None]
        reach[own] = False
        done = np.full(len(live), depth == n) | (reach.sum(axis=1) <= 4 * k)
        for row in np.flatnonzero(done).tolist():
            some = np.flatnonzero(reach[row])
            scores = c[some] @ q[live[row]]
            best = np.lexsort((ids[some], -scores))[:k] if len(some) else some
            found += [(int(live[row]), int(ids[some[b]]), int(scores[b])) for b in best]
        live = live[~done]
        if not len(live):
            break
    return found, read


def top_k(table: DataFrame, is_query: Column, k: int = 5, id_name: str = "vec_id", vector_name: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, id, score: the k best candidates of every row that ``is_query`` marks."""
    rows = integer_vectors(table, id_name, vector_name, scale)
    asked = integer_vectors(table.filter(is_query), id_name, vector_name, scale)
    # Queries that share an id and a vector would give the same rows twice.
    asked = asked.dropDuplicates(["id", "v"])
    candidates = staged(packed(rows, BLOCK, rows.count()), "top-candidates")
    queries = staged(packed(asked, QUERIES, asked.count()), "top-queries")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for n, ids, values, query_ids, query_values in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                own = np.frombuffer(query_ids, "<i8")
                found, _ = search_block(own, np.frombuffer(query_values, "<i8").reshape(-1, n), np.frombuffer(ids, "<i8"),
                                        np.frombuffer(values, "<i8").reshape(-1, n), k)
                out += [(int(own[row]), number, score) for row, number, score in found]
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["query_id", "id", "score"])

    blocks = queries.agg(F.max("block")).first()[0]
    of = F.explode(F.sequence(F.lit(0), F.lit(-1 if blocks is None else blocks), F.lit(1))).alias("of")
    dealt = candidates.select("n", "ids", "values", of) if blocks is not None else candidates.select("n", "ids", "values", F.lit(0).alias("of"))
    q = queries.select("n", F.col("block").alias("of"), F.col("ids").alias("query_ids"), F.col("values").alias("query_values"))
    pairs = dealt.join(q, ["n", "of"]).select("n", "ids", "values", "query_ids", "query_values")
    pairs = pairs.repartition(F.xxhash64("ids", "query_ids"))
    merged = pairs.mapInArrow(search, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
