"""Words of many texts at once: where they stand, and a 64-bit hash of each, by numpy over the joined bytes."""

from __future__ import annotations

import numpy as np

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A random 64-bit number for each byte, A-Z having those of a-z.
_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64).take(_LOWER)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2**64, and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        back = np.uint64(pow(int(_PRIME), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, p))), dtype=np.uint64) for p in (_PRIME, back)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of each number over all of it."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def hashed_words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts that lie one after another: hash of each, first byte, end, and offsets of the texts' words.

    Words are what stands between ASCII white space, with A-Z in lower case; a text's end ends a word.
    """
    n = len(body)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE.take(body)
    fresh = np.zeros(n + 1, bool)
    fresh[offsets[:-1][offsets[:-1] < n]] = True
    start = ~space
    start[1:] &= space[:-1] | fresh[1:n]
    ends = ~space
    ends[:-1] &= space[1:] | fresh[1:n]
    first, last = np.flatnonzero(start), np.flatnonzero(ends) + 1
    power, back = _powers(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE.take(body) * power, out=total[1:])
    hashes = mix((total[last] - total[first]) * back[first] ^ (last - first).astype(np.uint64) * _PRIME)
    return hashes, first, last, np.searchsorted(first, offsets)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, also across texts; the caller leaves those out."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(0x2545F4914F6CDD1D) + words[k : len(words) - n + 1 + k]
    return mix(out)


def spans_hashed(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words from each start to each end, equal for equal words."""
    power, back = _powers(max(len(words), 1))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return mix((total[end] - total[start]) * back[start] ^ (end - start).astype(np.uint64) * _PRIME)
