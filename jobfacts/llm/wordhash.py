"""Vectorised hashing of a text's words, for tasks that hold a few texts at a time."""

from __future__ import annotations

import numpy as np

from jobfacts.llm.common import by_value

by_value(__name__)
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = np.ones(1, dtype=_U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 64), _BASE, dtype=_U)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=_U)
    return _powers


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash per run of bytes that are not ASCII white space."""
    raw = np.frombuffer(text, dtype=np.uint8)
    solid = ~_SPACE[raw]
    edges = np.diff(solid.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, dtype=_U)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    sums = np.add.reduceat(_BYTES[raw[solid]] * _power_table(int(lengths.max()))[at], first)
    return mix(sums + lengths.astype(_U))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` consecutive words; of all words if there are fewer."""
    if not len(words):
        return words
    k = min(size, len(words))
    total = np.full(len(words) - k + 1, k, dtype=_U)
    for i in range(k):
        total = mix(total * _U(_BASE) + words[i:len(words) - k + 1 + i])
    return np.unique(total)
