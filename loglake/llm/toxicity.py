"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

A text is cut at white space into units. A unit keeps its letters only, in lower case, a
few digits and signs read as the letters they stand for; runs of single letters are one
unit. So marks put between the letters of a word change nothing. Letters beyond ASCII are
symbols of their own, by a hash of their code point. The kernel
compares two units by their common subsequences of three letters that lie within
``SPAN`` letters, weighted by ``DECAY`` to the length they span; letters put in between
lower the kernel but do not break it. Kernels are divided by the norms of both units; the
norm of a scored unit counts every subsequence once.

Landmarks are words and word beginnings (stems) that tell toxic documents from others by a
likelihood-ratio test. They are taken one by one, best first; a toxic document that holds k of
those taken counts 1 / (1 + k) in the test of the next, so that words of every language and kind get
their turn and words that only stand beside others do not. Of two that begin alike one is taken.
Nyström features of a unit are its kernels with all landmarks times the inverse
square root of the landmarks' own kernel. Labels belong to documents, and a document is
represented by its highest unit, or by the mean of its two highest (a latent support vector machine): squared
hinge loss by Newton steps, the representing units chosen anew in each round, and toxic documents far on the
clean side left out as mislabelled in the last rounds. The number of units and the cost are chosen by folds of the sample.
The landmarks, as they are and with a letter put in, are toxic units too. As the decision is linear in the kernels, it
collapses to one weight for each three letters, which makes scoring a table look-up.
A logistic curve fitted to the sampled documents makes a document's decision a score from 0 to 1.

Learned from a sample of ``sample_rows`` labelled rows (the expected size) that are not held out.

Defined cases: NULL, empty and letterless texts have no unit; their score is the curve's
lowest. A text with one unit is represented by it. Long texts are read whole; equal units of a text count as
often as they stand there. Without toxic and clean rows to learn from, every score is 0. Rows without a
doc_id or label are scored, and never learned from; rows whose doc_id has several labels
are learned from with the highest. Other columns are not looked at.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.arrays import SPACE, text_slices
from loglake.llm.sampling import held_out, labelled_sample
from loglake.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DECAY, SPAN = 0.8, 5
PLACES = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
LETTERS = 48
CODES = LETTERS**3
# Landmarks: beginnings of these lengths, and whole units; what the test must reach at least.
SHORTEST, LONGEST = 3, 12
CANDIDATES, LEAST_EVIDENCE = 4000, 12.0
COSTS = (1e-4, 1e-3, 1e-2)

# Letters a-z are 1 to 26, letters beyond ASCII share 27 to 47; anything else is dropped.
# Signs that stand for letters.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "@": "a"}
SYMBOL = np.zeros(256, dtype=np.int64)
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(1, 27)
for _sign, _letter in SIGNS.items():
    SYMBOL[ord(_sign)] = ord(_letter) - 96
STOP = np.zeros(256, dtype=bool)
STOP[[ord(c) for c in ".!?\n"]] = True


def symbols_of(data: np.ndarray) -> np.ndarray:
    """The symbol of every byte: of a letter of several bytes at its first, 0 at the others and at anything that is no letter."""
    out = SYMBOL[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.concatenate([data[1:], np.zeros(3, np.uint8)]).astype(np.int64)
        first, second, third = data[lead].astype(np.int64), padded[lead] & 63, padded[lead + 1] & 63
        code = np.where(first < 0xE0, ((first & 31) << 6) | second, ((first & 15) << 12) | (second << 6) | third)
        # Latin, Greek and Cyrillic capitals as small letters.
        code = np.where((code >= 0xC0) & (code < 0xDF) | (code >= 0x391) & (code < 0x3AA) | (code >= 0x410) & (code < 0x430), code + 32, code)
        letter = (code >= 0xDF) & (code != 0xF7) & ((code < 0x2000) | (code >= 0x2C00)) & ((code < 0x3000) | (code >= 0x3040)) & ((code < 0xFE00) | (code > 0xFE0F))
        hashed = (code * 2654435761 >> 7) % (LETTERS - 27) + 27
        out[lead] = np.where(letter | (first >= 0xF0), hashed, 0)
    return out


@dataclass
class Model:
    """Weight of every three letters, bias of the decision, and the curve from decision to score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    top: int  # how many of its highest units stand for a document


def units(data: np.ndarray, offsets: np.ndarray):
    """Symbols of all units in a row; for each unit its start, end, row and first byte."""
    symbols = symbols_of(data)
    space = SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    opens = ~space & (np.concatenate([[True], space[:-1]]) | cut[:-1]) if len(data) else space
    word = np.cumsum(opens) - 1
    kept = np.flatnonzero((symbols > 0) & ~space)
    if not len(kept):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    owner = word[kept]
    edge = np.concatenate([[True], owner[1:] != owner[:-1]])
    starts = np.flatnonzero(edge)
    sizes = np.diff(np.append(starts, len(kept)))
    rows = np.searchsorted(offsets, kept[starts], side="right") - 1
    # A single letter after a single letter of the same row goes on with its unit.
    joined = np.concatenate([[False], (sizes[1:] == 1) & (sizes[:-1] == 1) & (rows[1:] == rows[:-1])])
    starts, rows = starts[~joined], rows[~joined]
    return symbols[kept], starts, np.append(starts[1:], len(kept)), rows, kept[starts]


def subsequences(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For each pair of gaps: code of the three letters from every position on, weight, and whether they lie in one unit."""
    limit = np.repeat(ends, ends - starts)
    padded = np.concatenate([symbols, np.zeros(SPAN, np.int64)])
    at = np.arange(len(symbols))
    for i, j in PLACES:
        codes = (symbols * LETTERS + padded[i : i + len(symbols)]) * LETTERS + padded[j : j + len(symbols)]
        yield codes, DECAY ** (j + 1), at + j < limit


def norms(sizes: np.ndarray) -> np.ndarray:
    """Root of the sum of squared weights of all subsequences of units of these sizes."""
    total = np.zeros(len(sizes))
    for _, j in PLACES:
        total += np.maximum(sizes - j, 0) * DECAY ** (2 * (j + 1))
    return np.sqrt(np.maximum(total, DECAY**6))


def decisions(data: np.ndarray, offsets: np.ndarray, tables: np.ndarray):
    """Weighted sums of every unit for each table of letter weights, divided by its norm; rows; first bytes."""
    symbols, starts, ends, rows, first = units(data, offsets)
    if not len(starts):
        return np.zeros((0, len(tables)), np.float32), rows, first
    out = np.zeros((len(symbols), len(tables)), np.float32)
    packed = np.ascontiguousarray(tables.T.astype(np.float32))
    for codes, weight, inside in subsequences(symbols, starts, ends):
        part = packed[codes]
        part *= (inside * np.float32(weight))[:, None]
        out += part
    return np.add.reduceat(out, starts, axis=0) / norms(ends - starts)[:, None].astype(np.float32), rows, first


def spread(word: np.ndarray) -> np.ndarray:
    """Explicit kernel features of one unit, given as symbols."""
    out = np.zeros(CODES)
    for codes, weight, inside in subsequences(word, np.array([0]), np.array([len(word)])):
        np.add.at(out, codes[inside], weight)
    return out


def landmark_tables(landmarks: list[bytes]) -> np.ndarray:
    """Features of the landmarks, of length one."""
    features = np.stack([spread(np.frombuffer(w, np.uint8).astype(np.int64)) for w in landmarks])
    return features / np.sqrt((features**2).sum(axis=1))[:, None]


def beginnings(data: np.ndarray) -> set[bytes]:
    """The stems of a text, as symbols: beginnings of its units, and whole units, of allowed lengths."""
    symbols, starts, ends, _, _ = units(data, np.array([0, len(data)]))
    body = symbols.astype(np.uint8).tobytes()
    words = {body[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True) if e - s >= SHORTEST}
    return {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


def evidence(t, c, total_t: float, total_c: float):
    """Likelihood-ratio statistic of t toxic and c clean documents with a stem; 0 where it is no rarer in clean ones."""
    t, c = np.asarray(t, np.float64), np.asarray(c, np.float64)
    both = (t + c) / (total_t + total_c)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = t * np.log(t / (total_t * both)) + np.where(c > 0, c * np.log(c / (total_c * both)), 0)
    return np.where((t > 0) & (t / max(total_t, 1) > 3 * c / max(total_c, 1)), 2 * part, 0.0)


def choose_landmarks(sample: DataFrame, most: int, support: int) -> list[bytes]:
    """Stems that tell toxic documents of the sample from the others, best first.

    Stems are counted by Spark; the strongest ``CANDIDATES`` and the sample's documents that
    hold them, a bounded table, are looked at here.
    """
    def stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_pylist()
            for row, data, _ in text_slices(batch.column(1), limit=0):
                found = sorted(beginnings(data))
                yield pa.record_batch([pa.array(found, pa.binary()), pa.array([toxic[row]] * len(found), pa.int32())], names=["stem", "toxic"])

    rows = sample.select(F.col("toxic").cast("int"), "text").mapInArrow(stems, "stem binary, toxic int")
    counts = rows.groupBy("stem").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    total = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    total_t, total_c = float(total.get(1, 0)), float(total.get(0, 0))
    if not total_t or not total_c:
        return []
    both = (F.col("t") + F.col("c")) / (total_t + total_c)
    rest = F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (both * total_c))).otherwise(0.0)
    ranked = counts.filter((F.col("t") >= support) & (F.col("t") / total_t > 3 * F.col("c") / total_c))
    strongest = ranked.select("stem", "t", "c", (F.col("t") * F.log(F.col("t") / (both * total_t)) + rest).alias("e"))
    best = strongest.orderBy(F.desc("e"), "stem").limit(CANDIDATES).collect()
    if not best:
        return []
    names = [bytes(r["stem"]) for r in best]
    place = {w: k for k, w in enumerate(names)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(place[w] for w in beginnings(data) if w in place) for _, data, _ in text_slices(batch.column(0), limit=0)]
            yield pa.record_batch([pa.array(found, pa.list_(pa.int32()))], names=["held"])

    documents = [r["held"] for r in sample.filter("toxic = 1").select("text").mapInArrow(held, "held array<int>").collect()]
    member = np.zeros((len(names), len(documents)), np.float32)
    for k, found in enumerate(documents):
        member[found, k] = 1
    clean = np.array([r["c"] for r in best])
    taken, open_ = [], np.ones(len(names), bool)
    weight = np.ones(len(documents), np.float32)
    while len(taken) < most:
        strength = np.where(open_, evidence(member @ weight, clean, total_t, total_c), 0.0)
        top = strength.max()
        if top < LEAST_EVIDENCE:
            break
        # Of equally strong ones the longest says most.
        k = max(np.flatnonzero(strength >= top - 1e-9), key=lambda j: (len(names[j]), names[j]))
        taken.append(names[k])
        weight = 1 / (1 / weight + member[k])
        open_ &= ~np.array([w.startswith(names[k]) or names[k].startswith(w) for w in names])
    return taken


def kept_units(kernels: np.ndarray) -> np.ndarray:
    """The two units closest to each landmark: those that may represent a document."""
    if len(kernels) <= 2:
        return np.arange(len(kernels))
    return np.unique(np.argpartition(-kernels, 1, axis=0)[:2])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, landmarks: int = 48, seed: int = 10) -> Model | None:
    """Learn from a sample of the labelled rows that are not held out."""
    marks = labels.filter(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = labelled_sample(marks, "toxic", sample_rows, seed)
    # The chosen ids are as many as the sample has rows, so they are sent to the texts, not the texts to them.
    sample = staged(docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id"), "toxic-sample")
    words = choose_landmarks(sample, landmarks, 3)
    if not words:
        return None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = landmark_tables(words)
        for batch in batches:
            ids, toxic, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for row, data, offsets in text_slices(batch.column(2), limit=0):
                kernels, _, _ = decisions(data, offsets, tables)
                out.append((ids[row], toxic[row], kernels[kept_units(kernels)].astype("<f4").tobytes()))
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())],
                                  names=["doc_id", "toxic", "kernels"])

    rows = sample.select("doc_id", F.col("toxic").cast("int"), "text").mapInArrow(read, "doc_id long, toxic int, kernels binary").toPandas()
    rows = rows.sort_values(["doc_id", "kernels"], ignore_index=True)
    y = np.where(rows["toxic"] == 1, 1.0, -1.0)
    if len(set(y)) < 2:
        return None
    tables = landmark_tables(words)
    values, vectors = np.linalg.eigh(tables @ tables.T)
    whiten = vectors @ np.diag(np.maximum(values, 1e-2) ** -0.5) @ vectors.T
    bags = [(np.frombuffer(k, "<f4").reshape(-1, len(words)).astype(np.float64) if k else np.zeros((1, len(words)))) @ whiten for k in rows["kernels"]]
    certain = np.stack([tables @ spread(w) / norms(np.array([len(w)]))[0] for w in stretched(words)]) @ whiten
    start = whiten @ np.ones(len(words))
    folds = (rows["doc_id"].to_numpy() * 2654435761 >> 9) % 3
    tried = [(top, cost) for top in (1, 2) for cost in COSTS]
    top, cost = min(tried, key=lambda t: sum(_lost(bags, y, folds == k, certain, start, *t) for k in range(3)))
    weights, bias = latent_machine(bags, y, certain, start, top, cost)
    alpha = whiten @ weights
    highest = np.array([mean_of_top(b @ weights, top) for b in bags]) + bias
    slope, shift = logistic(highest, y)
    return Model((alpha[:, None] * tables).sum(axis=0), bias, slope, shift, top)


def _lost(bags: list[np.ndarray], y: np.ndarray, out: np.ndarray, certain: np.ndarray, start: np.ndarray, top: int, cost: float) -> float:
    """Share of a fold's documents, both kinds alike, that a machine learned from the others puts on the wrong side."""
    rest = np.flatnonzero(~out)
    if len(set(y[out])) < 2 or len(set(y[rest])) < 2:
        return 0.0
    weights, bias = latent_machine([bags[k] for k in rest], y[rest], certain, start, top, cost)
    wrong = np.array([mean_of_top(bags[k] @ weights, top) + bias for k in np.flatnonzero(out)]) * y[out] <= 0
    return wrong[y[out] > 0].mean() + wrong[y[out] < 0].mean()


def mean_of_top(values: np.ndarray, top: int) -> float:
    """The mean of the highest values; of fewer, of all."""
    return float(np.partition(values, -top)[-top:].mean()) if len(values) > top else float(values.mean())


def stretched(words: list[bytes]) -> list[np.ndarray]:
    """The words as symbols, and each with a foreign letter put in at each inner place."""
    foreign = bytes([24])
    made = words + [w[:k] + foreign + w[k:] for w in words for k in range(1, len(w))]
    return [np.frombuffer(w, np.uint8).astype(np.int64) for w in made]


def latent_machine(bags: list[np.ndarray], y: np.ndarray, certain: np.ndarray, start: np.ndarray, top: int, cost: float, rounds: int = 8):
    """Weights and bias by squared hinge loss; each bag stands for itself by the mean of its ``top`` highest rows.

    ``certain`` rows are toxic and stand for themselves. ``start`` gives every landmark the
    same decision. In each round the bags are fitted by Newton steps to the optimum; in the last
    rounds toxic bags far on the clean side count as labelled by mistake. Clean bags weigh one half in
    all, toxic bags and certain rows a quarter each.
    """
    theta = np.append(4.0 * start, -2.0)
    sure = np.concatenate([certain, np.ones((len(certain), 1))], axis=1)
    target = np.concatenate([y, np.ones(len(sure))])
    ridge = np.diag(np.append(np.full(len(theta) - 1, cost), 1e-6))
    for turn in range(rounds):
        x = np.stack([np.append(b[np.argsort(-(b @ theta[:-1]), kind="stable")[:top]].mean(axis=0), 1.0) for b in bags])
        kept = (y < 0) | (x @ theta > -1) | (turn < rounds // 2)
        share = kept * np.where(y > 0, 0.25 / max(1, (y[kept] > 0).sum()), 0.5 / max(1, (y[kept] < 0).sum()))
        share = np.concatenate([share, np.full(len(sure), 0.25 / len(sure))])
        x = np.concatenate([x, sure])
        for _ in range(60):
            short = share * (target * (x @ theta) < 1)
            solved = np.linalg.solve(ridge + (x * short[:, None]).T @ x, x.T @ (short * target))
            moved = np.abs(solved - theta).max()
            theta = theta + 0.5 * (solved - theta)
            if moved < 1e-6:
                break
    return theta[:-1], float(theta[-1])


def logistic(highest: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve that gives the labels their best likelihood (Newton steps, a small penalty)."""
    x = np.stack([highest, np.ones(len(highest))], axis=1)
    truth = (y > 0).astype(float)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (p - truth) + np.array([1e-2 * theta[0], 0])
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-6])
        move = np.linalg.solve(curve, slope)
        theta = theta - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def row_tops(values: np.ndarray, rows: np.ndarray, n: int, top: int) -> np.ndarray:
    """The mean of the one or two highest values of every row; a row without any has the lowest there is, or 0."""
    values = values.astype(np.float64)
    order = np.lexsort((-values, rows))
    first = np.searchsorted(rows[order], np.arange(n))
    count = np.bincount(rows, minlength=n)
    out = np.full(n, min(0.0, float(values.min(initial=0))))
    some, more = count > 0, count > 1 if top > 1 else np.zeros(n, bool)
    out[some] = values[order][first[some]]
    out[more] = (out[more] + values[order][first[more] + 1]) / 2
    return out


def scores(text, model: Model | None):
    """The score of a text column."""
    if model is None:
        return F.lit(0.0)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        table = model.weights[None, :]
        for _, data, offsets in text_slices(texts):
            values, rows, _ = decisions(data, offsets, table)
            out.append(1 / (1 + np.exp(-np.clip(model.slope * (row_tops(values[:, 0], rows, len(offsets) - 1, model.top) + model.bias) + model.shift, -30, 30))))
        return pa.array(np.concatenate(out))

    return score(text)


def toxic_report(docs: DataFrame, model: Model | None, bound: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scores(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= bound).cast("int"))
