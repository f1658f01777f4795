"""Weighted word shingles of texts, in numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from stratum.llm.common import mix64

SIZE = 5
CACHE_ENTRIES = 200_000
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x100000001B3)


class WordHashes(dict):
    """64-bit hashes of words, kept per worker."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        n = self[word] = xxhash.xxh64_intdigest(word.encode())
        return n


def word_hashes(text: str, known: WordHashes) -> np.ndarray:
    words = _WORD.findall(text.lower())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int = SIZE) -> np.ndarray:
    """A hash of every run of ``size`` words; a text of fewer words is one shingle."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        h = np.full(n, np.uint64(size))
        for i in range(size):
            h = mix64(h * _BASE + words[i:i + n])
    return h


def weighted(owner: np.ndarray, hashes: np.ndarray):
    """(owner, shingle, weight): each owner's distinct shingles and how often they occur."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    heads = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
    return o[heads], h[heads], np.diff(np.r_[heads, len(h)])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts' shingles; 0 without any."""
    if not len(a) or not len(b):
        return 0.0
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(nx[i], ny[j]).sum())
    return both / (len(a) + len(b) - both)
