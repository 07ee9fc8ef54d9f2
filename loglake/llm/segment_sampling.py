"""Distinct sampled segmentations of a text: Gumbel top-k over the SentencePiece lattice.

Every segmentation has the probability that the unigram model of ``pieces`` gives it. A
segmentation's key is its log probability plus Gumbel noise; the ``k`` largest keys are
a sample without replacement. The keys are never drawn one by one. The search is a
best-first search over sets of segmentations: a set is a common prefix and a first
step that is not one of those already taken, and its key is the maximum of the keys in it,
drawn from the backward sums of the lattice (log of the set's probability), truncated
by the key of the set it was split from. Taking the set with the largest key gives the next
sample: its step and the rest are drawn from the lattice, and the remainder is split
along the new path, one set for each step. The next key of a row is then known without
expanding anything else.

Since no piece reaches across a chunk (a word with the blanks before it), the lattice of a
text is a chain of chunk lattices. A chunk lattice is built once and kept while there is
room, and all chunks of a slice of texts step through their lattices together as arrays.

The score of a sample is its log probability; the inclusion score is the probability that
its key lies above the (k + 1)-th key, 1 - exp(-exp(log p - key)): 1 if the text has no
further segmentation. Dividing by it makes sums over samples unbiased.

All draws are hashes of the row key, the number of the sample and the position, so a row
has the same samples wherever and how often it is computed.

Defined cases: a NULL text is an empty one. A text is read with a blank before it, so the
empty text has the one segmentation of that blank. Fewer than ``k`` segmentations are all
returned. A NULL row key is a key like any other. Rows of equal key and text get equal
samples. Texts are taken whole, however long. An empty table gives no row. Other columns stay, but for one named ``samples``.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.llm.arrays import mix
from loglake.llm.pieces import CHUNK, MARK, MODEL_PATH, STEP, Pieces, PieceTable, code_hash, decode, load

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_CHARS = 1 << 19
# Room and slices of ``encode``, whose results are large.
SMALL_SHARE, SMALL_SLICE = 1 / 6, 1 << 17
GOLDEN = 0x9E3779B97F4A7C15
ALL = (1 << 64) - 1


class Numbers(dict):
    """Numbers keys in the order in which they are first looked up; ``fresh`` lists those that got a number since it was cleared."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


class Lattice:
    """Edges of distinct chunks by start node, with the odds of each edge at its node.

    A chunk of n characters has n + 1 nodes in a row; the last has no edges. Edge e leads
    from ``tail[e]`` to ``head[e]`` and stands for piece ``mark[e]``, or for the bytes of the
    character ``-1 - mark[e]``. ``upto[e]`` is the odds of its node's edges so far, 1 at the last.
    Chunks are kept between slices until the room is used up.
    """

    EDGES, NODES = 6_000_000, 3_000_000

    def __init__(self, pieces: Pieces, table: PieceTable, share: float = 1.0) -> None:
        self.pieces, self.table = pieces, table
        # With a smaller share of the room chunks are forgotten earlier; results do not depend on that.
        self.EDGES, self.NODES = int(share * Lattice.EDGES), int(share * Lattice.NODES)
        self.byte_ids = np.array(pieces.byte_ids, np.int32)
        self.score = np.full(len(pieces.texts), -np.inf)
        for text, number in pieces.ids.items():
            self.score[number] = pieces.scores[text]
        self._room(self.EDGES, self.NODES)

    def _room(self, edges: int, nodes: int) -> None:
        self.first = np.zeros(nodes + 1, np.int64)
        self.n_words = self.n_edges = self.n_nodes = 0
        self.tail, self.head, self.mark = (np.zeros(edges, np.int32) for _ in range(3))
        self.log_odds, self.upto = np.zeros(edges), np.zeros(edges)
        self.start = np.zeros(nodes + 1, np.int64)
        self.last = np.zeros(nodes, dtype=bool)
        self.number = Numbers()

    def place(self, rows: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the chunks of every row; chunks not seen yet are added."""
        numbers = self._numbers(rows)
        if self.number.fresh:
            sizes, *edges = self._edges(self.number.fresh)
            nodes = int((sizes + 1).sum())
            if self.n_nodes + nodes > len(self.last) or self.n_edges + len(edges[0]) > len(self.tail):
                self.number = Numbers()
                numbers = self._numbers(rows)
                words = self.number
                sizes, *edges = self._edges(words.fresh)
                self._room(max(self.EDGES, len(edges[0])), max(self.NODES, int((sizes + 1).sum())))
                self.number = words
            self._add(sizes, *edges)
            self.number.fresh.clear()
        ends = np.cumsum([0, *map(len, rows)]).tolist()
        return [numbers[low:high] for low, high in zip(ends[:-1], ends[1:], strict=True)]

    def _numbers(self, rows: list[list[str]]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, chain.from_iterable(rows)), np.int64, sum(map(len, rows)))

    def _edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Lengths of chunks in a row, and tail (from 0), length and mark of their edges in the order of the tails."""
        sizes = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        before = np.concatenate([[0], np.cumsum(sizes)])
        word = np.repeat(np.arange(len(words)), sizes)
        node = np.arange(len(codes)) + word
        left = before[word + 1] - np.arange(len(codes))
        hashed = code_hash(codes)
        live, sums = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        tails, lengths, marks = [], [], []
        for length in range(1, self.table.longest + 1):
            sums = sums + hashed[live + length - 1] * np.uint64(pow(STEP, length - 1, 1 << 64))
            found = self.table.look_up(sums)
            if length == 1:
                bare = (found < 0) | (codes == ord(MARK))
                found = np.where(codes == ord(MARK), -2, found)
                tails.append(live[bare]), lengths.append(np.ones(bare.sum(), np.int64))
                marks.append(-1 - codes[bare].astype(np.int64))
            whole = found >= 0
            tails.append(live[whole]), lengths.append(np.full(whole.sum(), length)), marks.append(found[whole].astype(np.int64))
            on = (found > -2) & (left[live] > length)
            live, sums = live[on], sums[on]
        tail, length, mark = (np.concatenate(x) for x in (tails, lengths, marks))
        order = np.argsort(tail, kind="stable")
        return sizes, node[tail[order]], length[order], mark[order]

    def _add(self, sizes: np.ndarray, tail: np.ndarray, length: np.ndarray, mark: np.ndarray) -> None:
        tail = self.n_nodes + tail
        score = self.score[np.maximum(mark, 0)]
        for k in np.flatnonzero(mark < 0).tolist():
            score[k] = self.pieces.spelled(chr(-1 - int(mark[k])))[1]
        ends = self.n_nodes + np.cumsum(sizes + 1)
        self._sum(tail, tail + length, mark, score, sizes)
        self.first[self.n_words + 1 : self.n_words + 1 + len(sizes)] = ends
        self.last[ends - 1] = True
        self.n_words += len(sizes)

    def _sum(self, tail, head, mark, score, sizes) -> None:
        """Backward sums from the ends of the chunks on, and the odds of each edge."""
        low, n = self.n_nodes, int((sizes + 1).sum())
        start = np.searchsorted(tail, low + np.arange(n + 1))
        back = np.zeros(n)
        left = np.repeat(np.cumsum(sizes + 1), sizes + 1) - 1 - np.arange(n)
        order, by_left = argsort(left), argsort(left[tail - low])
        levels = np.arange(1, int(left.max(initial=0)) + 2)
        bounds = np.searchsorted(left[order], levels)
        edge_bounds = np.searchsorted(left[tail - low][by_left], levels)
        to = head - low
        # The edges of a level lie side by side, in the order of their nodes.
        ordered, ordered_to, degrees = score[by_left], to[by_left], np.diff(start, append=len(tail))[order]
        for begin, end, first, last in zip(bounds[:-1], bounds[1:], edge_bounds[:-1], edge_bounds[1:], strict=True):
            counts = degrees[begin:end]
            at = np.cumsum(counts) - counts
            values = ordered[first:last] + back[ordered_to[first:last]]
            top = np.maximum.reduceat(values, at)
            back[order[begin:end]] = top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, counts)), at))
        logs = np.minimum(score + back[to] - back[tail - low], 0.0)
        within = np.exp(logs)
        rank = np.arange(len(tail)) - start[tail - low]
        by_rank = argsort(rank)
        ends = np.cumsum(np.bincount(rank))
        for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            at = by_rank[begin:end]
            within[at] += within[at - 1]
        final = np.flatnonzero(np.append(tail[1:] != tail[:-1], True))
        within[final] = 1.0
        new = slice(self.n_edges, self.n_edges + len(tail))
        self.tail[new], self.head[new], self.mark[new], self.log_odds[new] = tail, head, mark, logs
        self.upto[new] = within
        self.start[low : low + n + 1] = self.n_edges + start
        self.n_edges += len(tail)
        self.n_nodes += n

    def walk(self, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draw a path from every node to the end of its chunk: edges, and path offsets."""
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        lengths = np.zeros(len(nodes), np.int64)
        live = np.flatnonzero(~self.last[nodes])
        now = nodes[live]
        step = 0
        while len(live):
            draw = (mix(seeds[live] + np.uint64(step * GOLDEN % (1 << 64))) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = self.start[now]
            rest = np.flatnonzero(draw >= self.upto[edge])
            while len(rest):
                edge[rest] += 1
                rest = rest[draw[rest] >= self.upto[edge[rest]]]
            steps.append((live, edge))
            lengths[live] += 1
            now = self.head[edge]
            going = ~self.last[now]
            live, now = live[going], now[going]
            step += 1
        at = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(at[-1], np.int64)
        for number, (who, edge) in enumerate(steps):
            out[at[who] + number] = edge
        return out, at


def argsort(numbers: np.ndarray) -> np.ndarray:
    """Stable order of numbers from 0 on; small ones are sorted by digits, in linear time."""
    small = numbers.max(initial=0) < 1 << 16
    return np.argsort(numbers.astype(np.uint16) if small else numbers, kind="stable")


def gumbel_below(location, limit, draws):
    """Gumbel variables at ``location``, truncated to lie below ``limit``."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        out = location - np.log(np.exp(location - limit) - np.log(draws))
    return np.where(np.isneginf(location), -np.inf, np.minimum(out, limit))


def uniforms(seeds: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that follow from seed and step."""
    mixed = mix(seeds + (steps + 1).astype(np.uint64) * np.uint64(GOLDEN))
    return ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def seed_of(*parts: int) -> int:
    """A 64-bit number that follows from all parts."""
    out = 0x517CC1B727220A95
    for part in parts:
        out = ((out ^ (part & ALL)) * GOLDEN + 1) & ALL
        out = ((out ^ (out >> 30)) * 0xBF58476D1CE4E5B9) & ALL
        out = ((out ^ (out >> 27)) * 0x94D049BB133111EB) & ALL
        out ^= out >> 31
    return out


def uniform(seed: int) -> float:
    return ((seed_of(seed) >> 11) + 0.5) * 2.0**-53


class Search:
    """The best-first search of one row: its samples so far and the open sets."""

    def __init__(self, key: int, words: np.ndarray, k: int) -> None:
        self.key, self.words, self.k = key, words, k
        self.paths: list[np.ndarray] = []
        self.chunks: list[np.ndarray] = []
        self.keys: list[float] = []
        self.open: list[tuple[float, int, int, tuple[int, ...]]] = []  # key, path, step, edges already taken

    def begin(self) -> float:
        return -math.log(-math.log(uniform(seed_of(self.key, 1))))

    def split(self, path: np.ndarray, chunks: np.ndarray, key: float, keys: np.ndarray, since: int) -> None:
        """Keep the new path and open the sets that leave it at each step from ``since`` on."""
        number = len(self.paths)
        self.paths.append(path)
        self.chunks.append(chunks)
        self.keys.append(key)
        wanted = self.k + 1 - number
        keys = keys[since:]
        best = np.argpartition(-keys, wanted)[:wanted] if len(keys) > wanted else np.arange(len(keys))
        for step in best.tolist():
            if keys[step] > -math.inf:
                self.open.append((float(keys[step]), number, since + step, (int(path[since + step]),)))

    def take(self, lattice: Lattice) -> tuple[float, int, int, int]:
        """The open set with the largest key: key, path and step it leaves, edge drawn for it."""
        self.open.sort()
        key, number, step, taken = self.open.pop()
        path = self.paths[number]
        node = int(lattice.tail[path[step]])
        edges = [e for e in range(int(lattice.start[node]), int(lattice.start[node + 1])) if e not in taken]
        odds = np.exp(lattice.log_odds[edges])
        place = uniform(seed_of(self.key, 3, len(self.paths))) * odds.sum()
        at = min(int(np.searchsorted(np.cumsum(odds), place, side="right")), len(edges) - 1)
        rest = float(np.delete(odds, at).sum())
        if rest > 0:
            location = float(lattice.log_odds[path[:step]].sum()) + math.log(rest)
            draw = np.array([uniform(seed_of(self.key, 4, len(self.paths)))])
            self.open.append((float(gumbel_below(np.array([location]), key, draw)[0]), number, step, (*taken, edges[at])))
        return key, number, step, edges[at]

    def results(self, lattice: Lattice) -> list[tuple[np.ndarray, float, float]]:
        """Edges, log probability and inclusion score of every sample."""
        bound = max((o[0] for o in self.open), default=-math.inf)
        out = []
        for path in self.paths:
            log_p = float(lattice.log_odds[path].sum())
            gap = min(log_p - bound, 50.0) if bound > -math.inf else 50.0
            out.append((path, log_p, -math.expm1(-math.exp(gap))))
        return out


def sample_slice(texts: list[str], keys: list[int], k: int, lattice: Lattice) -> list[Search]:
    """The searches of a run of texts, each with its samples."""
    words = lattice.place([CHUNK.findall(" " + text) for text in texts])
    searches = [Search(key, own, k) for key, own in zip(keys, words, strict=True)]
    for turn in range(k):
        begun = []
        for search in searches:
            if turn == 0:
                begun.append((search, search.begin(), None, 0, 0, lattice.first[search.words], 0))
            elif len(search.paths) == turn and search.open:
                key, number, step, edge = search.take(lattice)
                chunk = int(search.chunks[number][step])
                nodes = np.concatenate([[lattice.head[edge]], lattice.first[search.words[chunk + 1 :]]])
                begun.append((search, key, number, step, edge, nodes, chunk))
        if not begun:
            break
        seeds = [np.arange(len(b[5]), dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed_of(b[0].key, 5, turn)) for b in begun]
        edges, at = lattice.walk(np.concatenate([b[5] for b in begun]), mix(np.concatenate(seeds)))
        low = 0
        grown = []
        for search, key, number, step, edge, nodes, chunk in begun:
            high = low + len(nodes)
            path = edges[at[low] : at[high]]
            where = np.repeat(np.arange(chunk, chunk + len(nodes)), np.diff(at[low : high + 1]))
            if number is not None:
                path = np.concatenate([search.paths[number][:step], [edge], path])
                where = np.concatenate([search.chunks[number][:step], [chunk], where])
            grown.append((search, key, path, where, step + 1 if number is not None else 0))
            low = high
        keys, bounds = leaving_keys(lattice, grown, turn)
        for n, (search, key, path, where, since) in enumerate(grown):
            search.split(path, where, key, keys[bounds[n] : bounds[n + 1]], since)
    return searches


def leaving_keys(lattice: Lattice, grown: list[tuple], turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of the set that leaves each new path at each of its steps; offsets of the paths."""
    sizes = np.array([len(g[2]) for g in grown])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    every = np.concatenate([g[2] for g in grown])
    logs = lattice.log_odds[every]
    before = np.zeros(len(every))
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        np.cumsum(logs[low : high - 1], out=before[low + 1 : high])
    nodes = lattice.tail[every]
    with np.errstate(divide="ignore"):
        others = before + np.log(np.maximum(-np.expm1(logs), 0.0))
    others[lattice.start[nodes + 1] - lattice.start[nodes] == 1] = -np.inf
    seeds = np.array([seed_of(g[0].key, 2, turn) for g in grown], np.uint64)
    draws = uniforms(np.repeat(seeds, sizes), np.arange(len(every)) - np.repeat(bounds[:-1], sizes))
    return gumbel_below(others, np.repeat([g[1] for g in grown], sizes), draws), bounds


def piece_ids(lattice: Lattice, path: np.ndarray) -> np.ndarray:
    """Ids of a path, characters without a piece spelled out."""
    marks = lattice.mark[path]
    plain = np.flatnonzero((marks < 0) & (marks >= -128))
    marks[plain] = lattice.byte_ids[-1 - marks[plain]]
    if not len(marks) or marks.min() >= 0:
        return marks
    spelled = [[m] if m >= 0 else lattice.pieces.spelled(chr(-1 - m))[0] for m in marks.tolist()]
    return np.array([i for part in spelled for i in part], np.int32)


def sampled(texts: list[str | None], keys: list, k: int, lattice: Lattice, seed: int, slice_chars: int = SLICE_CHARS):
    """For every text, in order: its samples as (ids, log probability, inclusion score)."""
    texts = [t or "" for t in texts]
    row = 0
    while row < len(texts):
        end, size = row, 0
        while end < len(texts) and (end == row or size + len(texts[end]) <= slice_chars):
            size += len(texts[end])
            end += 1
        seeds = [seed_of(seed, -1 if key is None else zlib.crc32(str(key).encode()), zlib.adler32(str(key).encode())) for key in keys[row:end]]
        for search in sample_slice(texts[row:end], seeds, k, lattice):
            yield [(piece_ids(lattice, path), log_p, inside) for path, log_p, inside in search.results(lattice)]
        row = end


SAMPLES = "array<struct<ids:array<int>,log_prob:double,inclusion:double>>"


def sample_array(rows) -> pa.Array:
    """Samples of many rows as one nested array."""
    ids, sizes, log_p, inside, counts = [np.zeros(0, np.int32)], [], [], [], []
    for row in rows:
        counts.append(len(row))
        for segments, p, q in row:
            ids.append(segments)
            sizes.append(len(segments))
            log_p.append(p)
            inside.append(q)
    ends = lambda lengths: pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    held = pa.ListArray.from_arrays(ends(sizes), pa.array(np.concatenate(ids).astype(np.int32)))
    structs = pa.StructArray.from_arrays([held, pa.array(log_p, pa.float64()), pa.array(inside, pa.float64())], names=["ids", "log_prob", "inclusion"])
    return pa.ListArray.from_arrays(ends(counts), structs)


def runs_of_bytes(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """First row and number of rows of runs of about ``limit`` bytes of text; a longer text is a run of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    run = (np.cumsum(sizes) - sizes) // limit
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(sizes) else np.zeros(0, np.int64)
    yield from zip(first.tolist(), np.diff(np.append(first, len(sizes))).tolist(), strict=True)


def encode(docs: DataFrame, k: int = 2, seed: int = 1, path: str = MODEL_PATH, key: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """The documents, or their ``keep`` columns, with ``samples``: up to k distinct segmentations, best key first."""
    pieces = load(path)
    table = PieceTable(pieces)
    names = [c for c in docs.columns if c != "samples"] if keep is None else keep

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, table, SMALL_SHARE)
        for batch in batches:
            for row, size in runs_of_bytes(batch.column(1), SMALL_SLICE):
                part = batch.slice(row, size)
                samples = sample_array(sampled(part.column(1).to_pylist(), part.column(0).to_pylist(), k, lattice, seed, SMALL_SLICE))
                yield pa.RecordBatch.from_arrays([*part.columns[2:], samples], names=[*names, "samples"])

    rows = docs.select(F.col(key).alias("key of the row"), F.col("text").alias("text of the row"), *names)
    schema = T.StructType([*rows.select(*names).schema.fields, T.StructField("samples", T._parse_datatype_string(SAMPLES))])
    return rows.mapInArrow(draw, schema)


def decoded(ids, path: str = MODEL_PATH):
    """The text of an array of piece ids."""
    pieces = load(path)

    @F.arrow_udf("string")
    def read(rows: pa.Array) -> pa.Array:
        return pa.array([None if row is None else decode(pieces, row) for row in rows.to_pylist()], pa.string())

    return read(ids)


def segment_report(docs: DataFrame, k: int = 2, seed: int = 1, path: str = MODEL_PATH) -> DataFrame:
    """One row for each sample: its rank, pieces, scores, a checksum of the ids, and whether they decode to the text.

    The same samples as ``encode`` gives, without carrying the ids.
    """
    pieces = load(path)
    table = PieceTable(pieces)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, table)
        for batch in batches:
            ids, texts, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for doc_id, text, row in zip(ids, texts, sampled(texts, ids, k, lattice, seed), strict=True):
                for rank, (segments, log_p, inside) in enumerate(row, 1):
                    sums = zlib.crc32(segments.astype("<i4").tobytes())
                    out.append((doc_id, rank, len(segments), log_p, inside, sums, decode(pieces, segments.tolist()) == (text or "")))
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    names = ["doc_id", "sample", "n_pieces", "log_prob", "inclusion", "ids_crc32", "decodes"]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        report, "doc_id long, sample int, n_pieces long, log_prob double, inclusion double, ids_crc32 long, decodes boolean")
