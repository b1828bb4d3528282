"""Hashes of all words or windows of a batch of texts at once, in numpy.

A batch is one byte array, the texts one after another. With prefix sums S of
T[b_i] * B^i modulo 2^64 (T a table of random odd numbers, B odd), the bytes from s
to e hash to (S[e] - S[s]) * B^-s, whatever stands before them: one subtraction and
one product for each word or window. ``mixed`` then spreads the bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLANK = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])


def _table() -> np.ndarray:
    return np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_KEPT: dict = {}


def _kept_powers(base: int, n: int) -> np.ndarray:
    """The first n powers; the longest table asked for is kept, rounded up so that few are made."""
    if len(_KEPT.get(base, ())) < n:
        _KEPT[base] = powers(base, -(-n // 65536) * 65536)
    return _KEPT[base][:n]


class Hasher:
    """Hashes of byte ranges of one array."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.multiply(_table()[data], _kept_powers(BASE, len(data)), out=self.sums[1:])
        np.cumsum(self.sums, out=self.sums)
        self.back = _kept_powers(INVERSE, len(data) + 1)

    def windows(self, width: int) -> np.ndarray:
        """The hashes of all windows of ``width`` bytes, as ``ranges`` has them."""
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:n]) * self.back[:n])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one array with a line feed after each, and where each begins (one more entry at the end)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), np.concatenate(([0], np.cumsum(sizes)))


def word_ranges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than white space."""
    inside = ~BLANK[data]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edge[0::2], edge[1::2]


def batched(values, limit: int = 4 << 20):
    """Lists of (index, bytes) of about ``limit`` bytes in all; a longer text is a list of its own."""
    held, size = [], 0
    for i, v in enumerate(values):
        held.append((i, v))
        size += len(v)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def portions(column, limit: int = 1 << 20):
    """(start, rows) of runs of an Arrow text column that hold about ``limit`` bytes; a longer text is a run of its own."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = (np.cumsum(size) - size) // limit
    edge = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(size))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        yield a, b - a
