"""Hashes of words, and of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words that a Python worker remembers before it starts anew.
REMEMBERED = 300_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """XXH3 of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit given."""
    hashes = (hashes ^ (hashes >> np.uint64(30))) * _MIXERS[0]
    hashes = (hashes ^ (hashes >> np.uint64(27))) * _MIXERS[1]
    return hashes ^ (hashes >> np.uint64(31))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` word hashes."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * _STEP + hashes[i : i + n]
    return mixed(total)
