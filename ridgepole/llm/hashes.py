"""Vectorised 64-bit hashes of substrings, for use inside tasks.

A run of symbols hashes to a polynomial in an odd base modulo 2**64 over a random value
for each symbol, then through a mixing step.  All substrings of a buffer follow from one
running sum, so a batch of texts is hashed in a few passes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=4)
def _powers(bits: int, base: int) -> np.ndarray:
    out = np.full((1 << bits) + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept for the usual sizes of batches."""
    bits = max(16, int(n).bit_length())
    if bits > 23:
        return _powers.__wrapped__(bits, base)
    return _powers(bits, base)


def symbols(count: int, seed: int) -> np.ndarray:
    """A fixed random value for each symbol."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))


class Prefix:
    """Hashes of any substrings of one buffer of symbol values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(n)[:n], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = powers(len(self._sums), _INVERSE)
        return (self._sums[ends] - self._sums[starts]) * back[starts]


def slices(sizes, limit: int):
    """Bounds (first, last) of runs of items that together stay near ``limit``."""
    first = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of all items of runs: starts[0], starts[0]+1, .., starts[1], .."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)
