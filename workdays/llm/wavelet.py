"""A wavelet matrix over small symbols: counts and places of any symbol, for many questions at once.

The symbols' bits are stored from the highest to the lowest; before each next level the symbols
are dealt stably into those with a 0 bit and those with a 1 bit. A question follows one place
through the levels. Levels are packed bits with the number of ones before each 64-bit word.
"""

from __future__ import annotations

import numpy as np

_WORD = 64


class _Bits:
    """One level: packed bits, ones before each word, number of zeros."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(-(-len(bits) // _WORD) * 8 + 8, dtype=np.uint8)
        raw = np.packbits(bits, bitorder="little")
        packed[: len(raw)] = raw
        self.words = packed.view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate((np.zeros(1, np.int64), np.cumsum(ones)))
        self.n = len(bits)
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each place."""
        word, bit = at // _WORD, (at % _WORD).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def find(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th (from 0) one or zero: the word by bisection, the bit inside by counting."""
        starts = np.arange(len(self.before), dtype=np.int64) * _WORD
        before = self.before if one else starts - self.before
        word = np.searchsorted(before, k, side="right") - 1
        value = self.words[word] if one else ~self.words[word]
        bits = np.unpackbits(value.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rank = (k - before[word])[:, None] + 1
        return word * _WORD + np.argmax(np.cumsum(bits, axis=1) >= rank, axis=1)


class WaveletMatrix:
    """``symbols`` below 2 ** ``levels``."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.n, self.levels, self.bits = len(symbols), levels, []
        for level in reversed(range(levels)):
            one = (symbols >> level & 1).astype(bool)
            self.bits.append(_Bits(one))
            if level:
                symbols = np.concatenate((symbols[~one], symbols[one]))

    def _bit(self, symbol: int, depth: int) -> bool:
        return bool(symbol >> (self.levels - 1 - depth) & 1)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        low, high = np.zeros(len(at), np.int64), np.asarray(at, dtype=np.int64)
        for depth, level in enumerate(self.bits):
            a, b = level.ones(low), level.ones(high)
            low, high = (level.zeros + a, level.zeros + b) if self._bit(symbol, depth) else (low - a, high - b)
        return high - low

    def rank_of(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How often any of ``symbols`` stands before each place."""
        return sum((self.rank(s, at) for s in symbols), np.zeros(len(at), np.int64))

    def select(self, symbol: int, k: np.ndarray) -> np.ndarray:
        """Place of the k-th (from 0) ``symbol``, which must be there."""
        first = np.zeros(1, np.int64)
        for depth, level in enumerate(self.bits):
            a = level.ones(first)
            first = level.zeros + a if self._bit(symbol, depth) else first - a
        at = first + np.asarray(k, dtype=np.int64)
        for depth, level in reversed(list(enumerate(self.bits))):
            one = self._bit(symbol, depth)
            at = level.find(at - level.zeros, True) if one else level.find(at, False)
        return at

    def bisect(self, symbols: tuple[int, ...], k: np.ndarray) -> np.ndarray:
        """Place of the k-th (from 0) among all of ``symbols`` together, by bisection on their ranks."""
        k = np.asarray(k, dtype=np.int64)
        low, high = np.zeros(len(k), np.int64), np.full(len(k), max(0, self.n - 1), np.int64)
        while np.any(low < high):
            middle = (low + high) // 2
            enough = self.rank_of(symbols, middle + 1) > k
            low, high = np.where(enough, low, middle + 1), np.where(enough, middle, high)
        return low
