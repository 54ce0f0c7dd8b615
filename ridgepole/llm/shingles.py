"""Hashed sets of word shingles of whole texts, by array operations over batches of bytes."""

from __future__ import annotations

import numpy as np

from ridgepole.llm import hashes

WORDS = 5
#: Bytes of texts that a task works on at a time.
BYTES = 1 << 18

#: Bits of the longest bitmap; single-precision sums count them exactly.
MOST_BITS = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUE = hashes.symbols(256, 7)[_LOWER]
_PLACE = hashes.symbols(WORDS, 11) | np.uint64(1)


def sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingles of each text.

    Words are stretches without the six ASCII blanks, A-Z in lower case.  A text of fewer
    than five words has one shingle, its whole sequence; one without words has none.
    """
    out: list[np.ndarray] = []
    for a, b in hashes.slices([len(t) for t in texts], BYTES):
        out += _sets(texts[a:b])
    return out


def _sets(texts: list[bytes]) -> list[np.ndarray]:
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    inside = ~_BLANK[raw]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    words = hashes.mix(hashes.Prefix(_VALUE[raw]).of(starts, ends) + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    cut = np.searchsorted(starts, bounds)
    whole = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        whole += words[k : k + len(whole)] * _PLACE[k]
    whole = hashes.mix(whole)
    out, first = [], 0
    for last in cut.tolist():
        n = last - first
        if n >= WORDS:
            own = np.sort(whole[first : last - WORDS + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif n:
            short = (words[first:last] * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(hashes.mix(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        first = last
    return out


def key(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    total = hashes.mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(hashes.mix(np.array([total], np.uint64)).view(np.int64)[0])


def bitmap(shingles: np.ndarray) -> bytes:
    """Whether a set's shingles in each bucket are odd in number; the buckets are a power of two, and as many as its shingles.

    A shingle that only one of two sets holds turns one bit, so their bitmaps differ in no
    more bits than the sets in shingles.
    """
    bits = min(MOST_BITS, max(64, 1 << (len(shingles) - 1).bit_length()))
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differences(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many bits each bitmap (a row of bytes) of ``left`` differs in from each of ``right``; longer ones are folded."""
    width = min(left.shape[1], right.shape[1])
    sides = []
    for side in (left, right):
        folded = np.bitwise_xor.reduce(side.reshape(len(side), -1, width), axis=1)
        sides.append(1 - 2 * np.unpackbits(folded, axis=1).astype(np.float32))
    return ((8 * width - sides[0] @ sides[1].T) / 2).astype(np.int64)


def difference(a: bytes, b: bytes) -> int:
    """How many bits two bitmaps differ in."""
    width = min(len(a), len(b))
    folded = [np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, width), axis=0) for x in (a, b)]
    return int(np.bitwise_count(folded[0] ^ folded[1]).sum())


def possible(apart: np.ndarray, total: np.ndarray, percent: int = 80) -> np.ndarray:
    """Whether sets of ``total`` shingles together that differ in ``apart`` or more can be similar."""
    return (100 + percent) * apart <= (100 - percent) * total


def similar(a: np.ndarray, b: np.ndarray, percent: int = 80) -> bool:
    """Whether 100 * intersection >= percent * union."""
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)
