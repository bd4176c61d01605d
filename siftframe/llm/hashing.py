"""Hashes of words and of runs of words, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

CACHED = 300_000  # word hashes a task remembers; then it starts anew
LONGEST = 16  # words of a run at most

# Odd multipliers, one per word of a run, in three independent rows.
FACTORS = np.random.default_rng(13).integers(1, 1 << 63, (3, LONGEST), np.uint64) | np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = value
        return value

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def runs(h: np.ndarray, size: int, row: int) -> np.ndarray:
    """A hash of each ``size`` consecutive words."""
    n = len(h) - size + 1
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += mixed(h[j : j + n] * FACTORS[row, j])
    return mixed(total)
