"""A cuckoo filter: set membership that allows deletion, as one block of bytes.

Buckets hold four 16-bit fingerprints. An item lives in one of two buckets; the second
follows from the first and the fingerprint alone, so items can be moved and taken out
without knowing their keys. A filter never says no to an item that is in it.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLOTS = 4
KICKS = 500


class Full(Exception):
    """No room was found for an item; the filter must be rebuilt with more buckets."""


def buckets_for(items: int) -> int:
    """A power of two that leaves at least a fifth of the slots free."""
    size = 4
    while size * SLOTS * 0.8 < items:
        size *= 2
    return size


def places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint and the two buckets of 64-bit keys."""
    keys = keys.astype(np.uint64, copy=False)
    prints = (keys >> np.uint64(48)).astype(np.int64) % 0xFFFF + 1
    one = (keys & np.uint64(size - 1)).astype(np.int64)
    return prints, one, one ^ moved(prints, size)


def moved(prints, size: int):
    return (prints * 0x5BD1E995 >> 3) & (size - 1)


def empty(size: int) -> np.ndarray:
    return np.zeros((size, SLOTS), dtype=np.uint16)


def contains(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    prints, one, two = places(keys, len(table))
    wanted = prints.astype(np.uint16)[:, None]
    return (table[one] == wanted).any(axis=1) | (table[two] == wanted).any(axis=1)


def insert(table: np.ndarray, keys: np.ndarray) -> None:
    """Put every key in once more, in place."""
    size = len(table)
    for mark, one, two in zip(*(a.tolist() for a in places(keys, size)), strict=True):
        at = one
        for bucket in (one, two):
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = mark
                break
        else:
            for kick in range(KICKS):
                slot = (kick * 7 + mark) % SLOTS
                mark, table[at, slot] = int(table[at, slot]), mark
                at ^= int(moved(mark, size))
                free = np.flatnonzero(table[at] == 0)
                if len(free):
                    table[at, free[0]] = mark
                    break
            else:
                raise Full


def delete(table: np.ndarray, keys: np.ndarray) -> None:
    """Take every key, each of which must be in, out once, in place."""
    for mark, one, two in zip(*(a.tolist() for a in places(keys, len(table))), strict=True):
        for bucket in (one, two):
            held = np.flatnonzero(table[bucket] == mark)
            if len(held):
                table[bucket, held[0]] = 0
                break


def built(keys: np.ndarray) -> np.ndarray:
    """A filter of these keys with room to spare."""
    size = buckets_for(len(keys))
    while True:
        table = empty(size)
        try:
            insert(table, keys)
            return table
        except Full:
            size *= 2


def changed(old: bytes | None, added: np.ndarray, gone: np.ndarray) -> np.ndarray | None:
    """The filter with keys added and taken out; None if it must be rebuilt."""
    table = empty(4) if old is None else from_bytes(old)
    delete(table, gone)
    if np.count_nonzero(table) + len(added) > table.size * 0.9:
        return None
    try:
        insert(table, added)
    except Full:
        return None
    return table


def to_bytes(table: np.ndarray) -> bytes:
    return table.tobytes()


def from_bytes(held: bytes) -> np.ndarray:
    return np.frombuffer(held, dtype=np.uint16).reshape(-1, SLOTS).copy()
