"""Hashes of all strings of a buffer of bytes, and anchors of its windows, in numpy.

The hash of any string is read off running sums of a polynomial in an odd base, modulo
2**64, over random values for the bytes. An anchor of a window is the place in it whose
gram of 64 bytes has the smallest hash, the first of equals: equal windows have it at the
same distance, and mostly consecutive windows share one.
"""

from __future__ import annotations

import numpy as np

GRAM = 64
#: Bytes hashed at a time; small enough for the arrays to stay in the processor's cache.
CHUNK = 1 << 16
PLACE = np.uint64(20)

_BYTES = np.random.default_rng(200).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_A, _B = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_S, _T = np.uint64(29), np.uint64(32)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _S)
    x *= _A
    x ^= x >> _T
    x *= _B
    x ^= x >> _S
    return x


class Strings:
    """Hashes of the strings of one buffer."""

    _up = powers(_BASE, 2 * CHUNK)
    _down = powers(pow(_BASE, -1, 2**64), 2 * CHUNK)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if n > len(self._up):
            raise ValueError("buffer too long")
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * self._up[:n], out=self.sums[1:])

    def hashes(self, start: np.ndarray, length) -> np.ndarray:
        raw = (self.sums[start + length] - self.sums[start]) * self._down[start]
        return scrambled(raw + np.asarray(length, dtype=np.uint64) * _B)

    def grams(self) -> np.ndarray:
        n = max(0, len(self.sums) - GRAM)
        raw = (self.sums[GRAM:] - self.sums[:n]) * self._down[:n]
        return scrambled(raw)


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of ``width`` grams from each position on, the first of equals."""
    low = np.arange(len(grams), dtype=np.uint64)
    least = (grams >> PLACE << PLACE) | low
    have = 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return (least & np.uint64((1 << 20) - 1)).astype(np.int64)
