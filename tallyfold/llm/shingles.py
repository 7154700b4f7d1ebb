"""Word shingles as 64-bit hashes, for tasks that work on Arrow batches."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

WIDTH = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words(text: bytes) -> list[bytes]:
    """Words of ASCII white space (\\x20, \\x09-\\x0D), with A-Z in lower case."""
    return text.lower().split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))


def gram_hashes(w: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, from the words' hashes."""
    n = len(w) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = w[:n].copy()
    for k in range(1, width):
        h *= _FACTOR
        h += w[k : n + k]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def shingle_set(text: bytes) -> np.ndarray:
    """Distinct shingles in ascending order; a text with fewer words is one shingle, one without words none."""
    w = word_hashes(words(text))
    if not len(w):
        return w
    if len(w) < WIDTH:
        return gram_hashes(np.append(w, np.full(1, len(w), np.uint64)), len(w) + 1)
    return np.unique(gram_hashes(w, WIDTH))
