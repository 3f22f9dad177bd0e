"""Word hashes, hashes of word n-grams, and sliding minima, as numpy arrays.

Words are ``[^\\x20\\x09-\\x0D]+`` (what ``bytes.split()`` cuts).  A word's hash is its 64-bit
XXH3; an n-gram's hash is a polynomial of its word hashes modulo 2**64, mixed.  Hashes of
different n-grams agree with probability 2**-64; 128-bit keys use two of them.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def grams(hashes: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hashes of all n-grams; ``which`` picks one of two independent hashes."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    own = hashes if which == 0 else mix(hashes + np.uint64(which))
    k = MULTIPLIERS[which]
    total = np.zeros(count, np.uint64)
    for j in range(n):
        total = total * k + own[j:j + count]
    return mix(total + np.uint64(n))


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct n-word shingles of a text, as hashes.  A text of fewer words is one
    shingle; a text without words has none."""
    hashes = hash_words(text.split())
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(grams(hashes, min(n, len(hashes))))


def sliding_min(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of every ``size`` successive values and its first place, by doubling."""

    def join(low: np.ndarray, at: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        later = low[shift:] < low[:-shift]
        return np.where(later, low[shift:], low[:-shift]), np.where(later, at[shift:], at[:-shift])

    step, low, at = 1, values, np.arange(len(values))
    while step * 2 <= size:
        low, at = join(low, at, step)
        step *= 2
    return join(low, at, size - step) if size > step else (low, at)
