"""Words and word shingles as 64-bit numbers, for the operators that compare texts word by word.

Words are runs of letters and digits in lower case, so punctuation, symbols and case tell no texts apart.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

SHINGLE = 5
_WORD = re.compile(r"[^\W_]+")
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class WordHashes(dict):
    """Hash of each word, remembered up to a bound."""

    def __init__(self, bound: int = 300_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.bound:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX
    return values ^ (values >> np.uint64(31))


def shingles(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hash of every window of ``width`` words, in text order; none if the text is shorter."""
    count = len(hashes) - width + 1
    if count < 1:
        return np.empty(0, np.uint64)
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total = total * _STEP + hashes[k : k + count]
    return mixed(total)
