"""Two tokenizers' views of one text, side by side: which tokens overlap, and where both end.

Tokenizer A is a byte-level vocabulary, B a SentencePiece model with byte pieces. Both give
the bytes of a blank and the text, so their tokens are intervals of the same bytes. Texts whose
tokens give other bytes (a U+2581 in the text, say) have no tokens here.

Neither tokenizer joins a character and a blank after it: A cuts its text there before it
merges, and no piece of B holds a blank after another character. So texts are cut before
single blanks between visible characters, and a segment that comes again is encoded once.

Lockstep merging. The texts of a chunk, a few MB, are encoded together; a state vector holds
one A and one B pointer for each of them. Every step emits the link of each pair of tokens
pointed at, marks a cut where both end at the same byte, and advances the pointer of the token
that ends first, or both. Texts that are through leave the vector. A long text takes
several places of the vector, from one shared end to a later one, so that the steps of a chunk
do not grow with its longest text.

Corpus-wide counts. An id pair is counted per chunk first, so a pair that stands in every text
is one row per chunk when rows move. The summed counts go back to the chunks that hold the pair,
in slices, and meet there the pairs of each text, which are kept as written deltas of places in
the chunk's list. Rows of one chunk meet in one task; its size is bounded by the chunk's.

Defined cases: a NULL or empty text has no tokens, and zeros. Repeated rows are aligned and
counted each. A text longer than a chunk is a chunk of its own, whole. An empty table
gives no row. ``aligned`` keeps the columns of its input and writes over those that bear the
names it adds; ``alignment_report`` looks at doc_id and text only.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

A_PATH, B_PATH = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 2 << 20
MOST_KNOWN, AT_ONCE = 1 << 18, 1 << 12
LANE_TOKENS = 1024
SLICE_PAIRS = 4096
READ = "text read by alignment"
# Before a blank between two characters that no reading takes for white space or a control character.
_VISIBLE = r"[^\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
CUT = re.compile(rf"(?<={_VISIBLE})(?= {_VISIBLE})")
SEGMENT = re.compile(rf"(?:{_VISIBLE}(?s:.)*)?{_VISIBLE}\Z")
WHOLE = "whole"


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Coders:
    """Both tokenizers, and the bytes of each of their tokens. The driver reads the files."""

    def __init__(self, a_path: str = A_PATH, b_path: str = B_PATH) -> None:
        with open(a_path, "rb") as a, open(b_path, "rb") as b:
            self.files = a.read(), b.read()
        self.ready = False

    def __getstate__(self) -> dict:
        return {"files": self.files, "ready": False}

    def open(self) -> Coders:
        if not self.ready:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            import sentencepiece
            from tokenizers import Tokenizer

            self.a = Tokenizer.from_str(self.files[0].decode())
            self.a.encode_special_tokens = True
            bytes_of = byte_of_char()
            vocabulary = self.a.get_vocab(with_added_tokens=True)
            added = {t["content"] for t in json.loads(self.files[0])["added_tokens"]}
            self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
            for token, number in vocabulary.items():
                self.a_bytes[number] = token.encode() if token in added else bytes(bytes_of[c] for c in token)
            self.b = sentencepiece.SentencePieceProcessor(model_proto=self.files[1])
            pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
            self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
            self.a_sizes, self.b_sizes = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
            self.ready = True
        return self

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for a blank and each text; none where the tokens do not give its bytes."""
        a = [e.ids for e in self.a.encode_batch([" " + s for s in segments], add_special_tokens=False)]
        b = self.b.encode(segments, num_threads=1)
        for k, segment in enumerate(segments):
            raw = (" " + segment).encode()
            if any(b"".join(map(table.__getitem__, ids[k])) != raw for table, ids in ((self.a_bytes, a), (self.b_bytes, b))):
                a[k], b[k] = [], []
        return a, b

    def encode_row(self, words: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], ...] | None:
        """As (ids, ends of each word) of A and B, for words that nothing is joined across; None if bytes are lost."""
        row = " ".join(words)
        raw = (" " + row).encode()
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        out = []
        for ids, table, sizes in (
            (self.a.encode(" " + row, add_special_tokens=False).ids, self.a_bytes, self.a_sizes), (self.b.encode(row), self.b_bytes, self.b_sizes)):
            if b"".join(map(table.__getitem__, ids)) != raw:
                return None
            ids = np.array(ids, np.int32)
            out.append((ids, np.searchsorted(np.cumsum(sizes[ids]), ends) + 1))
        return tuple(out)


class Segments:
    """Numbers of the segments of texts, without their blank, and the ids of each; emptied when it holds much."""

    def __init__(self, coders: Coders) -> None:
        self.coders = coders
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.regular: list[bool] = []
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.at = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def read(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, first token of every text) of A and of B."""
        if len(self.number) > MOST_KNOWN:
            self.clear()
        parts = [t.split(" ") if t else [] for t in texts]
        self._learn({w for p in parts for w in p})
        numbers = [list(map(self.number.__getitem__, p)) for p in parts]
        # Blanks beside blanks or line ends are cut nowhere: such texts are cut with care.
        odd = set(np.flatnonzero(~np.array(self.regular, bool)).tolist())
        if odd:
            careful = [k for k, found in enumerate(numbers) if not odd.isdisjoint(found)]
            cut = {k: [s[1:] for s in CUT.split(" " + texts[k])] for k in careful}
            self._learn({s for p in cut.values() for s in p}, whole=True)
            for k, p in cut.items():
                numbers[k] = [self.number[s] if self.regular[self.number[s]] else self.number[WHOLE, s] for s in p]
        return self._gather(numbers)

    def _gather(self, numbers: list[list[int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        flat, at = _flat(numbers)
        text_of = np.repeat(np.arange(len(numbers)), np.diff(at))
        sizes = [np.diff(begin) for begin in self.at]
        # A text with a segment that is not given back has no tokens.
        good = ~np.isin(text_of, np.unique(text_of[sizes[0][flat] == 0]))
        flat, text_of = flat[good], text_of[good]
        out = []
        for ids, begin, size in zip(self.ids, self.at, sizes, strict=True):
            n = size[flat]
            ends = np.cumsum(n)
            take = np.arange(int(n.sum())) + np.repeat(begin[:-1][flat] - (ends - n), n)
            first = np.zeros(len(numbers) + 1, np.int64)
            np.cumsum(np.bincount(text_of, n, len(numbers)).astype(np.int64), out=first[1:])
            out.append((ids[take].astype(np.int64), first))
        return out

    def _learn(self, found: set[str], whole: bool = False) -> None:
        """Encode what is new. A word with a blank, a line end or nothing at one of its ends is no segment
        by itself; it only gets a number, and the segments it is part of come as ``whole``."""
        new = [w for w in found if w not in self.number]
        plain = [w for w in new if SEGMENT.match(w)]
        for begin in range(0, len(plain), AT_ONCE):
            part = plain[begin : begin + AT_ONCE]
            row = self.coders.encode_row(part)
            if row is None:
                self._add(part, [_flat(ids) for ids in self.coders.encode(part)], True)
            else:
                self._add(part, [(ids, np.concatenate([[0], ends])) for ids, ends in row], True)
        others = [w for w in new if not SEGMENT.match(w)]
        self._add(others, [(np.zeros(0, np.int32), np.zeros(len(others) + 1, np.int64))] * 2, False)
        if whole:
            odd = [(WHOLE, s) for s in found if not self.regular[self.number[s]] and (WHOLE, s) not in self.number]
            for begin in range(0, len(odd), AT_ONCE):
                part = odd[begin : begin + AT_ONCE]
                self._add(part, [_flat(ids) for ids in self.coders.encode([s for _, s in part])], True)

    def _add(self, names: list, found: list[tuple[np.ndarray, np.ndarray]], regular: bool) -> None:
        for side, (ids, at) in enumerate(found):
            self.at[side] = np.concatenate([self.at[side], at[1:] + len(self.ids[side])])
            self.ids[side] = np.concatenate([self.ids[side], ids.astype(np.int32)])
        for name in names:
            self.number[name] = len(self.number)
        self.regular.extend([regular] * len(names))


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    at = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(x) for x in ids], out=at[1:])
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(at[-1])), at


@dataclass
class Chunk:
    """Texts of one chunk: ids, ends in the bytes of the whole chunk, and what the merging found."""

    a: np.ndarray
    a_at: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_at: np.ndarray
    b_end: np.ndarray
    link_a: np.ndarray  # token numbers in the chunk, in the order of the text
    link_b: np.ndarray
    link_at: np.ndarray  # first link of every text
    a_cuts: np.ndarray  # whether a token ends where one of the other side ends
    b_cuts: np.ndarray


def merge(segments: Segments, texts: list[str]) -> Chunk:
    """Encode the texts and merge their two token streams in lockstep."""
    (a, a_at), (b, b_at) = segments.read(texts)
    a_end, b_end = np.cumsum(segments.coders.a_sizes[a]), np.cumsum(segments.coders.b_sizes[b])
    link_a, link_b, a_cuts, b_cuts = lockstep(a_end, a_at, b_end, b_at)
    return Chunk(a, a_at, a_end, b, b_at, b_end, link_a, link_b, np.searchsorted(link_a, a_at), a_cuts, b_cuts)


def lanes(a_end: np.ndarray, a_at: np.ndarray, b_end: np.ndarray, size: int = LANE_TOKENS) -> np.ndarray:
    """First A token of every lane: of every text, and at shared ends about ``size`` tokens apart in long ones."""
    starts = a_at[:-1][a_at[:-1] < a_at[1:]]
    after = a_at[1:][a_at[:-1] < a_at[1:]]
    counts = (after - starts - 1) // size
    last = np.repeat(starts, counts) + size * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + 1) - 1
    found = np.zeros(0, np.int64)
    while len(last):
        place = np.searchsorted(b_end, a_end[last])
        shared = b_end[place] == a_end[last]
        found = np.concatenate([found, last[shared] + 1])
        last = last[~shared] + 1
    return np.unique(np.concatenate([starts, found[found < len(a_end)]]))


def lockstep(a_end: np.ndarray, a_at: np.ndarray, b_end: np.ndarray, b_at: np.ndarray, size: int = LANE_TOKENS) -> tuple[np.ndarray, ...]:
    """Links (A token, B token) in the order of the text, and the tokens of A and B that end at cuts."""
    a_cuts, b_cuts = np.zeros(len(a_end), bool), np.zeros(len(b_end), bool)
    if not len(a_end):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), a_cuts, b_cuts
    i = lanes(a_end, a_at, b_end, size)
    stop = np.append(i[1:], len(a_end))
    j = np.searchsorted(b_end, np.where(i > 0, a_end[i - 1], 0), side="right")
    # A lane with n and m tokens has fewer than n + m links.
    place = i + j
    found_a = np.full(len(a_end) + len(b_end), -1, np.int64)
    found_b = np.empty_like(found_a)
    while len(i):
        found_a[place], found_b[place] = i, j
        left, right = a_end[i], b_end[j]
        a_first, b_first = left <= right, right <= left
        both = a_first & b_first
        a_cuts[i], b_cuts[j] = both, both
        i, j, place = i + a_first, j + b_first, place + 1
        live = i < stop
        if not live.all():
            i, j, place, stop = i[live], j[live], place[live], stop[live]
    there = found_a >= 0
    return found_a[there], found_b[there], a_cuts, b_cuts


class Writer:
    """Writes the groups of a text as ``a1,a2|b1;a3|b2``."""

    def __init__(self, n_a: int, n_b: int) -> None:
        numbers = [str(k).encode() for k in range(max(n_a, n_b))]
        self.b_from = 2 * n_a
        self.words = [n + mark for n in numbers[:n_a] for mark in (b",", b"|")] + [n + mark for n in numbers[:n_b] for mark in (b",", b";", b"")]

    def texts(self, chunk: Chunk) -> Iterator[bytes]:
        a_group = np.cumsum(chunk.a_cuts) - chunk.a_cuts
        b_group = np.cumsum(chunk.b_cuts) - chunk.b_cuts
        groups = np.arange(int(chunk.a_cuts.sum()))
        b_before, a_until = np.searchsorted(b_group, groups), np.searchsorted(a_group, groups, side="right")
        last = np.zeros(len(chunk.b), bool)
        last[chunk.b_at[1:][chunk.b_at[1:] > chunk.b_at[:-1]] - 1] = True
        words = np.empty(len(chunk.a) + len(chunk.b), np.int64)
        words[np.arange(len(chunk.a)) + b_before[a_group]] = 2 * chunk.a + chunk.a_cuts
        words[np.arange(len(chunk.b)) + a_until[b_group]] = self.b_from + 3 * chunk.b + chunk.b_cuts + last
        at = (chunk.a_at + chunk.b_at).tolist()
        for begin, end in zip(at[:-1], at[1:], strict=True):
            yield b"".join(map(self.words.__getitem__, words[begin:end].tolist()))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows with about ``limit`` bytes of text; a batch is cut, and small ones are not joined."""
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        begin = size = 0
        for row, text in enumerate(texts):
            if size and size + len(text) > limit:
                yield batch.slice(begin, row - begin), texts[begin:row]
                begin, size = row, 0
            size += len(text)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


_LINKS = (
    "tokens_a array<struct<id: int, begin: long, end: long>>, tokens_b array<struct<id: int, begin: long, end: long>>, "
    "links array<struct<a: int, b: int>>, cuts array<long>"
)


def aligned(docs: DataFrame, text: str = "text", a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """The documents with the tokens of both sides as byte intervals of blank + text, the links between
    them (numbers of tokens) and the offsets at which tokens of both sides end."""
    coders = Coders(a_path, b_path)
    added = T.StructType.fromDDL(_LINKS)
    kept = [c for c in docs.columns if c not in added.fieldNames()]

    names = added.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(coders.open())
        for rows, texts in text_chunks(batches, READ):
            chunk = merge(segments, texts)
            columns = [_spans(chunk.a, chunk.a_at, chunk.a_end, coders.a_sizes), _spans(chunk.b, chunk.b_at, chunk.b_end, coders.b_sizes)]
            local = [found - np.repeat(at[:-1], np.diff(chunk.link_at)) for found, at in ((chunk.link_a, chunk.a_at), (chunk.link_b, chunk.b_at))]
            pairs = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in local], names=["a", "b"])
            columns.append(pa.ListArray.from_arrays(pa.array(chunk.link_at, pa.int32()), pairs))
            cut_at = np.concatenate([[0], np.cumsum(chunk.a_cuts)])[chunk.a_at]
            offsets = (chunk.a_end - np.repeat(_bases(chunk.a_at, chunk.a_end), np.diff(chunk.a_at)))[chunk.a_cuts]
            columns.append(pa.ListArray.from_arrays(pa.array(cut_at, pa.int32()), pa.array(offsets, pa.int64())))
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in kept] + columns, names=kept + names)

    schema = T.StructType([docs.schema[c] for c in kept] + added.fields)
    # The text is read under a name of its own, as a column may be written over.
    return docs.select(*kept, F.col(text).alias(READ)).mapInArrow(run, schema)


def _bases(at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Byte at which each text begins in the chunk."""
    return np.concatenate([[0], end])[at[:-1]]


def _spans(ids: np.ndarray, at: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> pa.Array:
    stop = end - np.repeat(_bases(at, end), np.diff(at))
    spans = pa.StructArray.from_arrays(
        [pa.array(ids, pa.int32()), pa.array(stop - sizes[ids], pa.int64()), pa.array(stop, pa.int64())], names=["id", "begin", "end"])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans)


_FOUND = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, "
    "first long, pairs array<long>, counts array<long>"
)


def alignment_report(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Per document: tokens, groups, links, and how often its linked id pairs are linked in the corpus."""
    coders = Coders(a_path, b_path)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _found(batches, coders.open())

    found = staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, _FOUND), "alignment")
    held = found.filter("pairs IS NOT NULL").select("chunk", "first", F.posexplode(F.arrays_zip("pairs", "counts")).alias("nth", "one"))
    held = held.select("chunk", "first", "nth", F.col("one.pairs").alias("pair"), F.col("one.counts").alias("n"))
    totals = held.groupBy("pair").agg(F.sum("n").alias("total"))
    # A B id has no more pairs than A has ids.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1))
    totals = totals.withColumn("best", F.col("total") == F.max("total").over(of_b))
    back = held.drop("n").join(totals, "pair").groupBy("chunk", "first").agg(F.sort_array(F.collect_list(F.struct("nth", "total", "best"))).alias("known"))
    back = back.select("chunk", "first", F.transform("known", lambda k: k["total"]).alias("pairs"),
                       F.transform("known", lambda k: k["best"].cast("long")).alias("counts"))
    texts = found.filter("pairs IS NULL").drop("first", "pairs", "counts")
    met = texts.unionByName(back, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", F.col("first").asc_nulls_last())
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    columns = [part.split()[0] for part in _FOUND.split(", ")]
    return met.select(columns).mapInArrow(_scored, out)


def _found(batches: Iterator[pa.RecordBatch], coders: Coders) -> Iterator[pa.RecordBatch]:
    """Rows of texts with the places of their pairs in the chunk's list, and that list in slices."""
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [part.split()[0] for part in _FOUND.split(", ")]
    number = TaskContext.get().partitionId() << 32
    pack = zstandard.ZstdCompressor(level=1).compress
    segments, writer = Segments(coders), Writer(len(coders.a_bytes), len(coders.b_bytes))
    for rows, texts in text_chunks(batches, "text"):
        chunk = merge(segments, texts)
        n = len(texts)
        place, pairs = pd.factorize((chunk.a[chunk.link_a] << 32) | chunk.b[chunk.link_b])
        counts = np.bincount(place, minlength=len(pairs))
        row_of = np.repeat(np.arange(n), np.diff(chunk.link_at))
        place = np.sort(row_of * (len(pairs) + 1) + place) - row_of * (len(pairs) + 1)
        digests = [hashlib.sha256(raw).hexdigest() if raw else "" for raw in writer.texts(chunk)]
        groups = np.diff(np.concatenate([[0], np.cumsum(chunk.a_cuts)])[chunk.a_at])
        bodies = [pack_places(place[chunk.link_at[k] : chunk.link_at[k + 1]], pack) for k in range(n)]
        slices = range(0, len(pairs), SLICE_PAIRS)
        m = len(slices)
        values = [
            [number] * (n + m), rows.column("doc_id").to_pylist() + [None] * m, np.diff(chunk.a_at).tolist() + [None] * m,
            np.diff(chunk.b_at).tolist() + [None] * m, groups.tolist() + [None] * m, np.diff(chunk.link_at).tolist() + [None] * m,
            digests + [None] * m, bodies + [None] * m, [None] * n + list(slices),
            [None] * n + [pairs[k : k + SLICE_PAIRS] for k in slices], [None] * n + [counts[k : k + SLICE_PAIRS] for k in slices],
        ]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)
        number += 1


def pack_places(places: np.ndarray, pack) -> bytes:
    """Sorted places as compressed differences, byte by byte of all."""
    return pack(np.diff(places, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_places(body: bytes, unpack) -> np.ndarray:
    planes = np.frombuffer(unpack(body), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel())


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a chunk, after the counts of the chunk's pairs."""
    unpack = zstandard.ZstdDecompressor().decompress
    open_chunk, parts = None, []
    totals = best = np.zeros(0, np.int64)
    for batch in batches:
        chunks, firsts = batch.column("chunk").to_numpy(), batch.column("first")
        keep, n_best, sums = [], [], []
        for row in range(batch.num_rows):
            if chunks[row] != open_chunk:
                open_chunk, parts = chunks[row], []
                totals = best = np.zeros(0, np.int64)
            if firsts[row].is_valid:
                parts.append([batch.column(c)[row].values.to_numpy() for c in ("pairs", "counts")])
                continue
            if parts:
                totals, best = (np.concatenate(x) for x in zip(*parts, strict=True))
                parts = []
            place = unpack_places(batch.column("places")[row].as_py(), unpack)
            keep.append(row)
            n_best.append(int(best[place].sum()))
            sums.append(int(totals[place].sum()))
        rows = batch.take(pa.array(keep, pa.int64()))
        columns = [rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        columns += [pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), rows.column("groups_sha256")]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
