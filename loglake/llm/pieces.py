"""A unigram model over the pieces of a public SentencePiece vocabulary.

The vocabulary file is never trained or changed. It orders its pieces by use, and gives ranks
instead of probabilities; a piece of rank r gets the probability of Zipf and
Mandelbrot, in proportion to 1 / (r + 2.7). Characters without a piece are spelled by
their byte pieces, as one step with the sum of the byte scores.

A text is read as SentencePiece does: a blank before it, blanks written as U+2581. A
U+2581 that is in the text itself is spelled by bytes, so decoding gives back every text.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import numpy as np
import sentencepiece
from pyspark import cloudpickle

from loglake.llm.arrays import mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
STEP = 0x9E3779B97F4A7C15
SHIFT = 2.7
# No piece holds a blank after another character, or a line feed: chunks are read alone.
CHUNK = re.compile(" *[^ \n]+|\n| +")


@dataclass
class Pieces:
    """Score and id of every piece by its text, with blanks as blanks, and the byte pieces."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    byte_score: list[float]
    longest: int
    texts: list[bytes]

    def spelled(self, char: str) -> tuple[list[int], float]:
        """Byte pieces of a character and the sum of their scores."""
        raw = char.encode("utf-8", "surrogatepass")
        return [self.byte_ids[b] for b in raw], sum(self.byte_score[b] for b in raw)


def load(path: str = MODEL_PATH) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    weights = 1.0 / (np.arange(n) + SHIFT)
    logs = np.log(weights / weights.sum()).tolist()
    ids: dict[str, int] = {}
    scores: dict[str, float] = {}
    byte_ids, byte_score, texts = [0] * 256, [0.0] * 256, [b""] * n
    for k in range(n):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            value = int(piece[3:5], 16)
            byte_ids[value], byte_score[value], texts[k] = k, logs[k], bytes([value])
        elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            plain = piece.replace(MARK, " ")
            texts[k] = plain.encode()
            if " " not in plain.lstrip(" ") and "\n" not in plain:
                ids[plain], scores[plain] = k, logs[k]
    return Pieces(ids, scores, byte_ids, byte_score, max(map(len, ids)), texts)


class PieceTable:
    """Pieces and all their beginnings in an open hash table, for looking up many at once."""

    BITS = 19

    def __init__(self, pieces: Pieces) -> None:
        self.longest = pieces.longest
        found: dict[int, int] = {}
        chars = sorted(set("".join(pieces.ids)))
        hashes = dict(zip(chars, code_hash(np.array([ord(c) for c in chars], np.uint32)).tolist(), strict=True))
        steps = [pow(STEP, length, 1 << 64) for length in range(pieces.longest)]
        for piece, number in pieces.ids.items():
            sums = 0
            for char, step in zip(piece, steps, strict=False):
                sums = (sums + hashes[char] * step) % (1 << 64)
                found.setdefault(sums, -1)
            found[sums] = number
        size = 1 << self.BITS
        self.keys = np.zeros(size, np.uint64)
        self.values = np.full(size, -2, np.int32)
        for key, number in found.items():
            slot = key >> (64 - self.BITS)
            while self.keys[slot]:
                slot = (slot + 1) % size
            self.keys[slot], self.values[slot] = key, number

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Piece number; -1 for the beginning of a piece; -2 for anything else."""
        slots = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        out = np.full(len(hashes), -2, np.int32)
        rest = np.arange(len(hashes))
        while len(rest):
            there = self.keys[slots]
            hit = there == hashes[rest]
            out[rest[hit]] = self.values[slots[hit]]
            more = ~hit & (there != 0)
            rest, slots = rest[more], (slots[more] + 1) % (1 << self.BITS)
        return out


def code_hash(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) + np.uint64(0x1234567))


def chunks(text: str) -> list[str]:
    """The parts of a text, with the blank before it, that no piece reaches across."""
    return CHUNK.findall(" " + text)


def decode(pieces: Pieces, ids: list[int]) -> str:
    """The text of a segmentation."""
    raw = b"".join(map(pieces.texts.__getitem__, ids))
    return raw[1:].decode("utf-8", "surrogatepass")
