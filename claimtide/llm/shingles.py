"""Hashes of words and of runs of words, for the operators that compare texts."""

from __future__ import annotations

import numpy as np
import xxhash

#: Most words a worker keeps the hash of; a full cache starts anew.
CACHED_WORDS = 1 << 18
#: Odd base of the polynomial over 64-bit word hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


KNOWN = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(KNOWN.__getitem__, words), np.uint64, len(words))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def rolling(hashes: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hash of every run of `length` words, modulo 2**64, then mixed.

    The hash of a run is the difference of two running sums, brought to the same
    power of the base.
    """
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(INVERSE, len(hashes)), out=sums[1:])
    return mixed((sums[length:] - sums[:n]) * powers(BASE, n + length)[length : length + n])
