"""Token counts by dynamic programming over a trie of pre-tokens.

A text is cut into pre-tokens (chunks that no piece of the vocabulary reaches across, see
``pieces``). The distinct pre-tokens of a slice of texts are put into a trie, one depth of all of them at
a time. Every node holds the best unigram score of the letters from the root to it, and its
number of pieces, computed once from the nodes above it, so pre-tokens that begin alike
share the work. The count at its last node is a pre-token's number of tokens; a text has
the sum over its pre-tokens.

Nodes are arrays. A node keeps the sum of its letters' hashes, so the hash of the letters
between two nodes of a path is a difference, and whether they are a piece is one look-up for all nodes
of a depth. The children known from slices before are found by bisection of (parent, letter).

The trie stays with its task for all batches and starts anew when it holds more than ``NODES``
nodes; counts do not depend on that. Nothing is shuffled.

Ties go to fewer pieces. Defined cases: a NULL text counts as an empty one, which is one
pre-token, the blank before every text. Texts are read whole; repeated rows are counted each. An
empty table gives no row. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.pieces import MARK, MODEL_PATH, STEP, Pieces, PieceTable, chunks, code_hash, load

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODES = 2_000_000
SLICE_CHARS, WORDS_AT_ONCE = 1 << 21, 1 << 16
CODE_BITS = 21  # of a code point
# Letters beyond this depth are scored for each pre-token by itself: hardly any two agree so far.
DEEP = 64
BACK = pow(STEP, -1, 1 << 64)


class Trie:
    """Best score and number of pieces of every beginning of the pre-tokens put in."""

    def __init__(self, pieces: Pieces, table: PieceTable | None = None) -> None:
        self.pieces, self.table = pieces, table or PieceTable(pieces)
        self.points = np.full(len(pieces.texts), -np.inf)
        for text, number in pieces.ids.items():
            self.points[number] = pieces.scores[text]
        self.spelled: dict[int, tuple[float, int]] = {}
        self.clear()

    def clear(self) -> None:
        self.counts: dict[str, int] = {}
        # Children by (parent, letter), in order; the rest by node.
        self.edges, self.child = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.sums, self.score, self.number = np.zeros(1, np.uint64), np.zeros(1), np.zeros(1, np.int64)

    def full(self) -> bool:
        return len(self.score) > NODES

    def add(self, word: str) -> int:
        """Put a pre-token in; its number of pieces."""
        if self.full():
            self.clear()
        self.put([word])
        return self.counts[word]

    def put(self, words: list[str]) -> None:
        """Put pre-tokens in that are not there yet."""
        sizes = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-sizes, kind="stable")
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        node = np.zeros(len(words), np.int64)
        path = [node]
        ends = np.zeros(len(words), np.int64)
        grown = []
        for depth in range(min(int(sizes.max(initial=0)), DEEP)):
            # Words are in order of length, so those that go on come first.
            live = int(np.searchsorted(-sizes, -depth, side="left"))
            letters = codes[first[:live] + depth].astype(np.int64)
            keys = (path[-1][:live] << CODE_BITS) | letters
            distinct, where, back = np.unique(keys, return_index=True, return_inverse=True)
            place = np.searchsorted(self.edges, distinct)
            known = np.zeros(len(distinct), bool)
            inside = place < len(self.edges)
            known[inside] = self.edges[place[inside]] == distinct[inside]
            nodes = np.empty(len(distinct), np.int64)
            nodes[known] = self.child[place[known]]
            nodes[~known] = len(self.score) + np.arange((~known).sum())
            fresh = where[~known]
            if len(fresh):
                self._score([p[fresh] for p in path[-self.pieces.longest :]], letters[fresh], depth)
                grown.append((distinct[~known], nodes[~known]))
            path.append(nodes[back])
            done = int(np.searchsorted(-sizes, -(depth + 1), side="left"))
            ends[done:live] = path[-1][done:live]
            # Only ancestors that a piece can reach back to are needed.
            if len(path) > self.pieces.longest:
                path[-self.pieces.longest - 1] = path[-self.pieces.longest - 1][:0]
        if grown:
            edges = np.concatenate([self.edges, *[e for e, _ in grown]])
            child = np.concatenate([self.child, *[c for _, c in grown]])
            by_edge = np.argsort(edges, kind="stable")
            self.edges, self.child = edges[by_edge], child[by_edge]
        counts = np.empty(len(words), np.int64)
        counts[order] = self.number[ends]
        for k in range(int(np.searchsorted(-sizes, -DEEP, side="left"))):
            counts[order[k]] = self._rest(words[order[k]], [int(p[k]) for p in path[-self.pieces.longest :]])
        self.counts.update(zip(words, counts.tolist(), strict=True))

    def _rest(self, word: str, path: list[int]) -> int:
        """Number of pieces of a word beyond the depth of the trie; ``path`` holds the nodes of its last letters there."""
        state = [(float(self.score[n]), int(self.number[n])) for n in path]
        scores = self.pieces.scores
        for i in range(DEEP, len(word)):
            best, number = -np.inf, 0
            for back in range(len(state), 0, -1):
                points = scores.get(word[i + 1 - back : i + 1])
                if points is not None and word[i] != MARK:
                    points += state[-back][0]
                    if points > best or (points == best and state[-back][1] < number - 1):
                        best, number = points, state[-back][1] + 1
            if word[i] == MARK or word[i] not in scores:
                points, n = self._spell(ord(word[i]))
                if points + state[-1][0] > best:
                    best, number = points + state[-1][0], state[-1][1] + n
            state.append((best, number))
            if len(state) > self.pieces.longest:
                del state[0]
        return state[-1][1]

    def _score(self, path: list[np.ndarray], letters: np.ndarray, depth: int) -> None:
        """Append new nodes at ``depth`` + 1; ``path`` holds their ancestors, the nearest last."""
        parent = path[-1]
        steps = np.uint64(pow(STEP, depth, 1 << 64))
        sums = self.sums[parent] + code_hash(letters.astype(np.uint32)) * steps
        best, number = np.full(len(letters), -np.inf), np.zeros(len(letters), np.int64)
        bare = letters == ord(MARK)
        for length in range(len(path), 0, -1):
            above = path[-length]
            found = self.table.look_up((sums - self.sums[above]) * np.uint64(pow(BACK, depth + 1 - length, 1 << 64)))
            if length == 1:
                bare = bare | (found < 0)
            hit = np.flatnonzero((found >= 0) & (letters != ord(MARK)))
            points = self.points[found[hit]] + self.score[above[hit]]
            fewer = self.number[above[hit]] + 1
            better = (points > best[hit]) | ((points == best[hit]) & (fewer < number[hit]))
            hit, points, fewer = hit[better], points[better], fewer[better]
            best[hit], number[hit] = points, fewer
        bare = np.flatnonzero(bare)
        if len(bare):
            own = [self._spell(int(c)) for c in letters[bare].tolist()]
            points = np.array([p for p, _ in own]) + self.score[parent[bare]]
            better = points > best[bare]
            number[bare[better]] = (self.number[parent[bare]] + np.array([n for _, n in own]))[better]
            best[bare[better]] = points[better]
        self.sums, self.score, self.number = (np.concatenate(x) for x in ((self.sums, sums), (self.score, best), (self.number, number)))

    def _spell(self, code: int) -> tuple[float, int]:
        """Score and number of the byte pieces of a letter."""
        if code not in self.spelled:
            ids, points = self.pieces.spelled(chr(code))
            self.spelled[code] = (points, len(ids))
        return self.spelled[code]


def text_slices(texts: list[str | None]) -> Iterator[list[str]]:
    """Runs of texts of about ``SLICE_CHARS`` characters; a longer text is a run of its own."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def count_tokens(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every document."""
    pieces = load(path)
    table = PieceTable(pieces)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(pieces, table)
        for batch in batches:
            cut, tokens = [], []
            for texts in text_slices(batch.column(1).to_pylist()):
                words = [chunks(text) for text in texts]
                distinct = set().union(*words)
                if trie.full():
                    trie.clear()
                fresh = sorted(distinct - trie.counts.keys())
                for begin in range(0, len(fresh), WORDS_AT_ONCE):
                    trie.put(fresh[begin : begin + WORDS_AT_ONCE])
                cut += [len(w) for w in words]
                tokens += [sum(map(trie.counts.__getitem__, w)) for w in words]
            yield pa.record_batch([batch.column(0), pa.array(cut, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_pretokens long, n_tokens long")
