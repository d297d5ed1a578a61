"""Vectorised 64-bit hashing of characters, words and shingles (arithmetic modulo 2**64)."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_tables: list[np.ndarray] = []

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0.. of an odd base and of its inverse, at least ``n`` of each."""
    if not _tables or len(_tables[0]) < n:
        size = max(1 << 18, 1 << n.bit_length())
        _tables[:] = [
            np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64), dtype=np.uint64)))
            for b in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _tables[0], _tables[1]


def word_hashes(raw: bytes, piece: int = 1 << 18) -> np.ndarray:
    """One hash per word of UTF-8 text: runs of other than space, tab, LF, VT, FF, CR, in lower-case A-Z.

    Long texts go in pieces cut behind a space, so the scratch memory stays small.
    """
    made, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + piece)
        while end < len(raw) and not _SPACE[raw[end - 1]]:
            end += 1
        made.append(_words_of(raw[at:end]))
        at = end
    return np.concatenate(made) if made else np.empty(0, np.uint64)


def _words_of(raw: bytes) -> np.ndarray:
    b = _LOWER[np.frombuffer(raw, np.uint8)]
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[b]
    edges = np.diff(inside)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = powers(len(b))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], dtype=np.uint64)))
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_shingles(raw: bytes, k: int) -> np.ndarray:
    """Ascending distinct hashes of all runs of ``k`` words; fewer words are one shingle, none give none."""
    words = word_hashes(raw)
    if not len(words):
        return words
    up, _ = powers(k + 1)
    n = max(1, len(words) - k + 1)
    h = np.full(n, min(k, len(words)), dtype=np.uint64)
    for j in range(min(k, len(words))):
        h += mix64(words[j : j + n] + up[j + 1])
    return np.unique(mix64(h))
