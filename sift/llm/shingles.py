"""Words and hashed word shingles, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

# Words whose hashes a task remembers at most; then it starts anew.
MEMORY = 100_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def split_words(text: str | None) -> list[bytes]:
    """Runs without space, tab, \\n, \\v, \\f, \\r, as UTF-8, A-Z in lower case."""
    return (text or "").encode().lower().split()


class WordHashes(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMORY:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words, in order; of all words if they are fewer."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    mixed = np.full(n, k, np.uint64)
    for i in range(k):
        mixed = (mixed ^ hashes[i : i + n]) * _FACTOR
        mixed ^= mixed >> _SHIFT
    return mixed


def shingle_set(words: list[bytes], k: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves."""
    if not words:
        return set()
    k = min(k, len(words))
    return set(zip(*(words[i : len(words) - k + 1 + i] for i in range(k)), strict=True))
