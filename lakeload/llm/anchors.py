"""Anchored windows: every window of a fixed length is owned by one position inside it, chosen by content alone.

The owner of a window is the leftmost smallest hash among its first positions, so equal windows have owners at equal
offsets, wherever they stand.  Consecutive windows with one owner form a row: its core (the units from the owner on
that all its windows share) and its context (all units of its windows).  Windows can only repeat where cores repeat,
and rows of one context repeat as a whole, which leaves few windows to compare one by one.
"""

from __future__ import annotations

import numpy as np


def mix(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers, as numbers whose upper half is used."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def owned(hashes: np.ndarray, windows: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, owner) of each run of windows with one owner.  Window p has the positions
    p .. p + width - 1 to choose from; ``hashes`` covers them all."""
    if windows <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    n = windows + width - 1
    keys = (hashes[:n] & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    owner = (smallest(keys, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    return starts, np.diff(np.append(starts, windows)), owner[starts]


def byte_grams(data: bytes) -> np.ndarray:
    """A hash of the eight bytes at each position (of the last seven bytes: none)."""
    return mix(np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,)).copy())


# Windows looked at together; bounds the memory that one long text takes.
SEGMENT = 1 << 20


def all_owned(hashes: np.ndarray, windows: int, width: int):
    """``owned`` over all windows, a segment at a time."""
    for at in range(0, max(windows, 0), SEGMENT):
        n = min(SEGMENT, windows - at)
        first, count, owner = owned(hashes[at:at + n + width - 1], n, width)
        yield first + at, count, owner + at
