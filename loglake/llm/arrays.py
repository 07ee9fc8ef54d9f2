"""Words and shingles of text columns as numpy arrays, in slices of bounded size.

All hashes are 64 bits wide and do not depend on the process, the batch or the slice.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 1 << 19
ROWS_AT_ONCE = 500
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTERS = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = known.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = known[base] = np.multiply.accumulate(steps)
    return have[:n]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes, and row offsets of runs of at most ``rows`` rows of about ``limit`` bytes.

    A NULL is an empty text. A row longer than the limit is a slice of its own, whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    # Cast a part at a time: a batch of long texts is held once only.
    for base in range(0, len(column), ROWS_AT_ONCE):
        part = pc.fill_null(column.slice(base, ROWS_AT_ONCE).cast(pa.large_string()), "")
        _, at, body = part.buffers()
        offsets = np.frombuffer(at, dtype=np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
        row = 0
        while row < len(part):
            end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), row + rows, len(part))
            yield base + row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of word bytes; no run crosses a row."""
    if not len(is_word):
        none = np.zeros(0, np.int64)
        return none, none, none
    before = np.empty_like(is_word)
    before[0] = False
    before[1:] = is_word[:-1]
    before[offsets[:-1][offsets[:-1] < len(is_word)]] = False
    after = np.empty_like(is_word)
    after[-1] = False
    after[:-1] = is_word[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: dict[int, np.ndarray]) -> np.ndarray:
    """A hash of the bytes of every span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(LETTERS[data] * powers(BASE, n, known), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, n + 1, known)[starts])


def shingles(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row, and their row offsets.

    A row with fewer words than that has one shingle, of all its words; without words none.
    """
    counts = np.bincount(rows, minlength=n_rows)
    first = np.zeros(n_rows + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    made = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    at = np.zeros(n_rows + 1, np.int64)
    np.cumsum(made, out=at[1:])
    start = np.repeat(first[:-1] - at[:-1], made) + np.arange(at[-1])
    length = np.repeat(np.minimum(counts, size), made)
    out = length.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for k in range(size):
        factor = np.uint64(pow(INVERSE, 2 * k + 3, 1 << 64))
        out += np.where(k < length, mix(padded[start + k] + np.uint64(k)) * factor, np.uint64(0))
    return mix(out), at
