"""Benchmark passages in documents, also with other numbers, names and units.

A text becomes words (runs of ASCII letters and digits and of all other characters beyond
ASCII). In the template of a text, numbers, names (capitalised words that do not begin a
sentence) and units after a number are replaced by a placeholder of their type; other
words are A-Z lower-cased. A number with points or commas between its digits is one word. In a
second, opened template capitalised words that begin a sentence are names too. Windows of
``WINDOW`` words of a benchmark item, as templates and as plain words, are joined by hash with
the windows of the documents. Dense windows, with more slots than plain words, count only in
an alignment that another window has found.

An item counts as contained when, in one alignment of document and item, ``ENOUGH`` of its
windows match (13 words in a row), or all if it has fewer. A place of the item counts once,
whether as plain words or as template; templates count if the slots of the document map one to one
onto those of the item along the alignment: one value, one replacement. Items shorter than a window are
one window of their whole length; below ``FEWEST`` words an item is no passage and matches
nothing.

Item windows are dealt in blocks of at most ``BLOCK`` hashes by the hash; a task holds one
block as a sorted array, 8 MB at most, and the documents are read once for each block. For a
benchmark of up to a million windows that is one read.

Defined cases: NULL and empty texts match nothing. Rows without an item_id are no items.
Documents without a doc_id are reported under NULL, and are never removed. Repeated rows
are reported once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.arrays import LOWER, mix, span_hashes, text_slices, word_spans
from loglake.llm.names import unused
from loglake.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, FEWEST, ENOUGH = 8, 5, 6
BLOCK = 1 << 20
PLAIN, TEMPLATE, DENSE, OPENED, OPENED_DENSE = range(5)

# Units that follow a number.
UNITS = (
    "%", "percent", "mm", "cm", "m", "km", "meter", "meters", "metre", "metres", "kilometers", "kilometres", "inch",
    "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "mg", "g", "kg", "gram", "grams", "kilograms",
    "ounce", "ounces", "pound", "pounds", "lb", "lbs", "ton", "tons", "ml", "l", "liter", "liters", "litre", "litres",
    "gallon", "gallons", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days",
    "week", "weeks", "month", "months", "year", "years", "mph", "kmh", "dollar", "dollars", "cent", "cents", "euro",
    "euros", "usd", "eur", "degrees", "celsius", "fahrenheit", "w", "kw", "watts", "v", "volts", "hz", "khz", "mhz", "j",
    "joules", "n", "newtons", "pa", "kpa", "kb", "mb", "gb", "tb", "bytes",
)

WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[48:58] = WORD_BYTE[65:91] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True
STOP_BYTE = np.zeros(256, dtype=bool)
STOP_BYTE[[ord(c) for c in ".!?:;\n"]] = True
NOT_DIGIT = np.ones(256, dtype=bool)
NOT_DIGIT[48:58] = False
NUMBER, NAME, UNIT = (np.uint64(v) for v in (0x6E756D626572, 0x6E616D65, 0x756E6974))
NONE = np.zeros(0, np.int64)


def runs(values: np.ndarray, rows: np.ndarray, length: int, salt: int) -> np.ndarray:
    """Hash of ``length`` values from every position on; only meant where the row goes on so far."""
    n = len(values) - length + 1
    out = np.full(n, salt * 64 + length, dtype=np.uint64)
    for k in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + mix(values[k : n + k] + np.uint64(k))
    return mix(out).view(np.int64)


def spans(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends, rows of all words, and which bytes are points or commas between digits."""
    digit = ~NOT_DIGIT[data]
    joint = np.zeros(len(data), bool)
    joint[1:-1] = ((data[1:-1] == 44) | (data[1:-1] == 46)) & digit[:-2] & digit[2:]
    joint[offsets[:-1][offsets[:-1] < len(data)]] = False
    joint[offsets[1:][offsets[1:] > 0] - 1] = False
    return *word_spans(WORD_BYTE[data] | joint, offsets), joint


def canonical(data: np.ndarray, offsets: np.ndarray, known: dict):
    """Spans, rows, plain hashes of words; hashes and slots of the template and of the opened template."""
    starts, ends, rows, joint = spans(data, offsets)
    words = span_hashes(LOWER[data], starts, ends, known)
    if not len(starts):
        return starts, ends, rows, words, [(words, np.zeros(0, bool))] * 2
    count = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    stops, odd = count(STOP_BYTE[data]), count(NOT_DIGIT[data] & ~joint)
    number = odd[ends] == odd[starts]
    same_row = np.concatenate([[False], rows[1:] == rows[:-1]])
    inside = same_row & (stops[starts] == stops[np.concatenate([[0], ends[:-1]])])
    first = data[starts]
    capital = (first >= 65) & (first <= 90)
    after_number = same_row & np.concatenate([[False], number[:-1]])
    units = span_hashes(*unit_words(), known)
    unit = after_number & np.isin(words, units)
    both = []
    for name in (capital & inside, capital):
        both.append((np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, words))), number | name | unit))
    return starts, ends, rows, words, both


def unit_words() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    body = "".join(UNITS).encode()
    ends = np.cumsum([len(u.encode()) for u in UNITS])
    return np.frombuffer(body, np.uint8), np.concatenate([[0], ends[:-1]]), ends


def windows(data: np.ndarray, offsets: np.ndarray, lengths: list[int], known: dict):
    """Row, word position, kind, length, hash of all windows, and how to read their slots."""
    starts, ends, rows, words, templates = canonical(data, offsets, known)
    first_word = np.searchsorted(rows, np.arange(len(offsets) - 1))
    found = []
    closed, opened = (np.concatenate([[0], np.cumsum(slot)]) for _, slot in templates)
    for length in lengths:
        n = len(words) - length + 1
        if n <= 0:
            continue
        at = np.flatnonzero(rows[:n] == rows[length - 1 :])
        found.append((at, np.full(len(at), PLAIN), length, runs(words, rows, length, PLAIN)[at]))
        fewer = closed[at + length] - closed[at]
        for kind, typed, some in ((TEMPLATE, fewer, fewer > 0), (OPENED, more := opened[at + length] - opened[at], more > fewer)):
            kinds = np.where(2 * typed[some] <= length, kind, kind + 1)
            found.append((at[some], kinds, length, runs(templates[kind == OPENED][0], rows, length, TEMPLATE)[at[some]]))

    def values(at: int, length: int, kind: int) -> list[str]:
        if kind == PLAIN:
            return []
        slot = templates[int(kind >= OPENED)][1]
        held = [bytes(LOWER[data[starts[k] : ends[k]]]).decode("utf-8", "replace") for k in range(at, at + length) if slot[k]]
        return [v.replace(",", "") for v in held]

    return found, rows, first_word, values


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_pos, kind, length, hash, slots, n_windows) of every item."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for row, data, offsets in text_slices(batch.column(1), limit=0):
                starts = spans(data, offsets)[0]
                if len(starts) < FEWEST:
                    continue
                found, _, _, values = windows(data, offsets, [min(WINDOW, len(starts))], known)
                for at, kind, length, hashes in found:
                    out += [(ids[row], int(p), int(k), length, int(h), values(p, length, k))
                            for p, k, h in zip(at, kind, hashes, strict=True)]
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                  names=["item_id", "item_pos", "kind", "length", "hash", "slots"])

    items = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    items = items.select(F.col("item_id").cast("long"), "text").dropDuplicates()
    return items.mapInArrow(read, "item_id long, item_pos int, kind int, length int, hash long, slots array<string>")


def hits(docs: DataFrame, known_hashes: np.ndarray, lengths: list[int], whole: bool) -> DataFrame:
    """Windows of the documents whose hash is among the known ones.

    If ``known_hashes`` are the whole benchmark, dense windows are left out in documents where nothing else matches.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        filled = np.zeros(1 << 16, dtype=bool)
        filled[known_hashes & 0xFFFF] = True
        for batch in batches:
            ids, rows_out = batch.column(0), []
            cols: list[list] = [[], [], [], []]
            for row, data, offsets in text_slices(batch.column(1)):
                found, rows, first_word, values = windows(data, offsets, lengths, known)
                known_here = []
                for at, kind, length, hashes in found:
                    some = np.flatnonzero(filled[hashes & 0xFFFF])
                    place = np.minimum(np.searchsorted(known_hashes, hashes[some]), len(known_hashes) - 1)
                    known_here.append(some[known_hashes[place] == hashes[some]])
                seeded = np.full(len(offsets) - 1, not whole)
                for (at, kind, _, _), some in zip(found, known_here, strict=True):
                    seeded[rows[at[some[~np.isin(kind[some], (DENSE, OPENED_DENSE))]]]] = True
                for (at, kind, length, hashes), some in zip(found, known_here, strict=True):
                    for k in some[seeded[rows[at[some]]]].tolist():
                        p = int(at[k])
                        rows_out.append(row + int(rows[p]))
                        cols[0].append(p - int(first_word[rows[p]]))
                        cols[1].append(int(kind[k]))
                        cols[2].append(int(hashes[k]))
                        cols[3].append(values(p, length, int(kind[k])))
            yield pa.record_batch(
                [ids.take(pa.array(rows_out, pa.int64())), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.string()))],
                names=["doc_id", "pos", "kind", "hash", "values"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        read, "doc_id long, pos long, kind int, hash long, values array<string>")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per (document, item it contains): doc_id, item_id, n_windows, n_matched, verbatim."""
    items = staged(item_windows(benchmark), "benchmark-windows")
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())
    n_hashes = items.select("hash").distinct().count()
    blocks = -(-n_hashes // BLOCK) or 1
    parts = []
    for k in range(blocks):
        held = items.filter(F.pmod("hash", F.lit(blocks)) == k).select("hash").distinct().toArrow().column(0)
        parts.append(hits(docs, np.sort(held.to_numpy()), lengths, blocks == 1) if len(held) else None)
    found = [p for p in parts if p is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_windows long, n_matched long, verbatim boolean")
    sizes = items.filter(F.col("kind") == PLAIN).groupBy("item_id").agg(F.countDistinct("item_pos").alias("n_windows"))
    met = reduce(DataFrame.unionByName, found).join(items, ["kind", "hash"])
    zipped = F.arrays_zip(F.col("slots").alias("theirs"), F.col("values").alias("ours"))
    pairs = lambda last: F.array_distinct(F.flatten(F.collect_set(F.when(F.col("kind") <= last, zipped))))
    places = lambda last: F.size(F.collect_set(F.when(F.col("kind") <= last, F.col("item_pos"))))
    lines = met.groupBy("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.max(~F.col("kind").isin(DENSE, OPENED_DENSE)).alias("seeded"), places(PLAIN).alias("n_plain"),
        places(DENSE).alias("n_closed"), pairs(DENSE).alias("closed"), places(OPENED_DENSE).alias("n_opened"), pairs(OPENED_DENSE).alias("opened"))
    one_to_one = lambda c: (F.size(c) == F.size(F.array_distinct(f"{c}.theirs"))) & (F.size(c) == F.size(F.array_distinct(f"{c}.ours")))
    matched = F.greatest("n_plain", F.when(one_to_one("closed"), F.col("n_closed")), F.when(one_to_one("opened"), F.col("n_opened")))
    needed = F.least(F.lit(ENOUGH), "n_windows")
    enough = lines.filter("seeded").withColumn("n_matched", matched.cast("long")).join(sizes, "item_id").filter(F.col("n_matched") >= needed)
    return enough.groupBy("doc_id", "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.max("n_matched").alias("n_matched"), F.max(F.col("n_plain") >= needed).alias("verbatim"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no benchmark item."""
    found = unused(docs, "_gone")
    gone = contaminated(docs, benchmark).select(F.col("doc_id").alias(found)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(found), "left_anti")
