"""Word shingles as 64-bit numbers, and MinHash signatures over them, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
# Odd multipliers, one for each place in a shingle (fixed values).
_PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)
_BLOCK = 4096


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 5-word shingles; fewer words make one shingle, no words none."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    count = max(1, len(found) - SHINGLE_WORDS + 1)
    total = np.zeros(count, np.uint64)
    for place in range(min(SHINGLE_WORDS, len(found))):
        total += hashed[place : place + count] * _PLACES[place]
    # The number of words keeps a short text apart from every full shingle.
    return np.unique(_mix(total + np.uint64(min(len(found), SHINGLE_WORDS))))


class Permutations:
    """``count`` universal hash functions a * x + b modulo 2^64; the upper 32 bits are compared."""

    def __init__(self, count: int, seed: int):
        rng = np.random.default_rng(seed)
        self.count = count
        self.a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, count, dtype=np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The least value of every function over the set, as uint32; all ones for an empty set."""
        least = np.full(self.count, 0xFFFFFFFF, np.uint64)
        for start in range(0, len(shingles), _BLOCK):
            values = shingles[start : start + _BLOCK, None] * self.a[None, :]
            values += self.b[None, :]
            least = np.minimum(least, values.min(axis=0) >> np.uint64(32))
        return least.astype(np.uint32)
