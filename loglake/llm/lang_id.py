"""Language of a text from averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of 2, 3 and 4 bytes of a text, A-Z lower-cased and other ASCII
characters that are no letters taken as a blank; each falls into one of ``BUCKETS``. A
text is the mean of the embeddings of all its subwords. Embeddings and softmax are fitted
by stochastic gradient descent in numpy on a bounded sample (``sample_rows`` rows, the
expected size) of the labelled rows. One part in five of the sample is kept for
calibration: a temperature for the scores, and the score below which a prediction
is rejected, chosen so that at most ``loss`` of the right predictions would go.

Defined cases: a NULL text, or one without any letter, is ``und`` with score 0 and is
rejected. Rows without a label or without a doc_id are never learned from, but are
predicted. Without any row to learn from, every text is ``und``. Ties go to the
language that sorts first. Columns called like the new ones are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.arrays import text_slices
from loglake.llm.names import unused
from loglake.llm.sampling import held_out, labelled_sample

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 13
WIDTH = 16
ORDERS = (2, 3, 4)
BLANK = 32
SLICE_ROWS = 512
UNKNOWN = "und"

LETTER_BYTES = np.full(256, BLANK, dtype=np.uint32)
LETTER_BYTES[97:123] = np.arange(97, 123)
LETTER_BYTES[65:91] = np.arange(97, 123)
LETTER_BYTES[128:] = np.arange(128, 256)


@dataclass
class Model:
    """Score of every bucket for every language, and the rule for rejection."""

    languages: list[str]
    buckets: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def subword_means(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of every bucket among the subwords of each row."""
    n_rows = len(offsets) - 1
    codes = LETTER_BYTES[data]
    rows = np.repeat(np.arange(n_rows), np.diff(offsets))
    total = np.zeros(n_rows * BUCKETS)
    for order in ORDERS:
        n = len(codes) - order + 1
        if n <= 0:
            continue
        grams = codes[:n].copy()
        blank = BLANK
        for k in range(1, order):
            grams |= codes[k : n + k] << np.uint32(8 * k)
            blank |= BLANK << (8 * k)
        whole = (rows[:n] == rows[order - 1 :]) & (grams != np.uint32(blank))
        hashed = ((grams ^ np.uint32(order * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)) >> np.uint32(19)
        total += np.bincount(rows[:n][whole] * BUCKETS + hashed[whole], minlength=len(total))
    shares = total.reshape(n_rows, BUCKETS)
    return (shares / np.maximum(shares.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


class Shares:
    """Rows of shares of all buckets, kept as the buckets that are not zero and laid out when asked for."""

    def __init__(self, packed: list) -> None:
        self.packed = packed

    def __len__(self) -> int:
        return len(self.packed)

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), BUCKETS), np.float32)
        for k, row in enumerate(rows.tolist()):
            raw = self.packed[row].as_buffer()
            n = len(raw) // 6
            out[k, np.frombuffer(raw, np.uint16, n)] = np.frombuffer(raw, np.float32, n, 2 * n)
        return out


def descend(x: Shares, learned: np.ndarray, y: np.ndarray, n_labels: int, epochs: int, rate: float, seed: int):
    """Embeddings, softmax weights and bias after stochastic gradient descent over the ``learned`` rows."""
    draw = np.random.default_rng(seed)
    embed = draw.normal(0, 1.0, (BUCKETS, WIDTH)).astype(np.float32)
    weights = np.zeros((WIDTH, n_labels), np.float32)
    bias = np.zeros(n_labels, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for rows in np.array_split(learned[draw.permutation(len(learned))], max(1, len(learned) // 16)):
            some = x[rows]
            hidden = some @ embed
            error = softmax(hidden @ weights + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            back = error @ weights.T
            weights -= step * (hidden.T @ error)
            bias -= step * error.sum(axis=0)
            used = np.flatnonzero(some.any(axis=0))
            embed[used] -= 40 * step * (some[:, used].T @ back)
    return embed, weights, bias


def calibrate(logits: np.ndarray, y: np.ndarray, loss: float) -> tuple[float, float]:
    """The temperature with the best likelihood, and the score that ``loss`` of the right ones miss."""
    options = np.geomspace(0.1, 10, 41)
    likely = [np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).sum() for t in options]
    temperature = float(options[int(np.argmax(likely))])
    scores = softmax(logits / temperature)
    right = scores.max(axis=1)[scores.argmax(axis=1) == y]
    lowest = float(np.quantile(right, loss, method="lower")) if len(right) else 0.0
    return temperature, min(lowest * 0.9, 0.5)


def fit(docs: DataFrame, sample_rows: int = 2400, loss: float = 0.002, epochs: int = 12, seed: int = 7) -> Model | None:
    """Learn from a sample of the rows that carry a label and are not held out."""
    readable = docs.filter(F.col("text").rlike("\\p{L}")).select(F.col("doc_id").cast("long"), "lang", "text")
    sample = labelled_sample(readable, "lang", sample_rows, seed)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, data, offsets in text_slices(batch.column(2), rows=SLICE_ROWS):
                for row in subword_means(data, offsets):
                    at = np.flatnonzero(row)
                    out.append(at.astype(np.uint16).tobytes() + row[at].astype(np.float32).tobytes())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["doc_id", "lang", "x"])

    rows = sample.mapInArrow(features, "doc_id long, lang string, x binary").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    labels = rows.column("lang").to_pylist()
    languages = sorted(set(labels))
    number = {name: k for k, name in enumerate(languages)}
    # On the driver the rows stay packed: laid out, the sample takes 32 KB a row.
    x, y = Shares([row for chunk in rows.column("x").chunks for row in chunk]), np.array([number[name] for name in labels])
    kept_back = np.arange(len(x)) % 5 == 4
    learned, checked = np.flatnonzero(~kept_back), np.flatnonzero(kept_back if kept_back.any() else ~kept_back)
    embed, weights, bias = descend(x, learned, y, len(languages), epochs, 0.5, seed)
    temperature, threshold = calibrate(x[checked] @ embed @ weights + bias, y[checked], loss)
    return Model(languages, (embed @ weights).astype(np.float32), bias, temperature, threshold)


def predicted(text: Column, model: Model | None) -> Column:
    """A struct of lang_pred, score and rejected for a text column."""
    nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if model is None:
        return nothing

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pa.Array) -> pa.Array:
        best, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        for _, data, offsets in text_slices(texts, rows=SLICE_ROWS):
            logits = subword_means(data, offsets) @ model.buckets + model.bias
            odds = softmax(logits.astype(np.float64) / model.temperature)
            best.append(odds.argmax(axis=1))
            scores.append(odds.max(axis=1))
        score = np.concatenate(scores)
        names = pa.array(model.languages, pa.string()).take(pa.array(np.concatenate(best)))
        return pa.StructArray.from_arrays(
            [names, pa.array(score), pa.array(score < model.threshold)], names=["lang_pred", "score", "rejected"])

    return F.when(F.coalesce(text.rlike("\\p{L}"), F.lit(False)), predict(text)).otherwise(nothing)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents with lang_pred, score and rejected, written over columns of these names."""
    found = unused(docs, "_language")
    named = docs.withColumn(found, predicted(F.col("text"), model))
    out = named.withColumns({name: F.col(f"`{found}`.{name}") for name in ("lang_pred", "score", "rejected")})
    return out.drop(found)


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents whose prediction is not rejected, with their own columns only; all, without a model."""
    if model is None:
        return docs
    found = unused(docs, "_language")
    return docs.withColumn(found, predicted(F.col("text"), model)).filter(~F.col(f"`{found}`.rejected")).drop(found)


def language_report(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
