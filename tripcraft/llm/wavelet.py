"""Wavelet matrix over a symbol array, with vectorised rank.

Each level keeps one bit per symbol, packed into 64-bit words, and the number
of ones before every word; ``rank`` answers many queries in one NumPy pass.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit array with rank; 1.5 bits of memory for each bit."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, bool)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.uint32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.zeros = n - int(self.before[-1])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Number of set bits before each position."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.width = max(1, int(n_symbols - 1).bit_length())
        self.levels = []
        rest = symbols
        for bit in range(self.width - 1, -1, -1):
            ones = (rest >> bit & 1).astype(bool)
            self.levels.append(Bits(ones))
            rest = np.concatenate([rest[~ones], rest[ones]])
        self.last = rest
        # Where each symbol's block begins once all bits have been followed.
        self.base = np.zeros(n_symbols, np.int64)
        if len(rest):
            first = np.flatnonzero(np.r_[True, rest[1:] != rest[:-1]])
            self.base[rest[first]] = first

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbols[k] before position i[k]."""
        for level, bit in zip(self.levels, range(self.width - 1, -1, -1), strict=True):
            ones = level.ones(i)
            i = np.where(symbols >> bit & 1, level.zeros + ones, i - ones)
        return i - self.base[symbols]

    def children(self, low: np.ndarray, high: np.ndarray):
        """All (symbol, rank at low, rank at high) with an occurrence in [low, high)."""
        for level in self.levels:
            a, b = level.ones(low), level.ones(high)
            c, d = low - a, high - b
            zero, one = d > c, b > a
            low = np.concatenate([c[zero], level.zeros + a[one]])
            high = np.concatenate([d[zero], level.zeros + b[one]])
        symbol = self.last[low].astype(np.int64)
        base = self.base[symbol]
        return symbol, low - base, high - base


def bounded_suffix_order(symbols: np.ndarray, n_symbols: int, depth: int) -> np.ndarray:
    """Suffixes ordered by at least their first ``depth`` symbols (prefix doubling).

    Ties beyond that depth stay in any order: the rows whose suffixes start with
    a pattern of up to ``depth`` symbols still are one run, and the counts that
    backward search takes from the Burrows-Wheeler transform are the same.
    """
    n = len(symbols)
    bits, wide = max(1, int(n_symbols - 1).bit_length()), max(1, n.bit_length())
    packed = max(1, min((62 - wide) // bits, depth))
    key = np.zeros(n, np.int64)
    for j in range(min(packed, n)):
        key[:n - j] |= symbols[j:].astype(np.int64) << bits * (packed - 1 - j)
    small = bits * packed + wide <= 63
    while True:
        if small:  # one plain sort of (key, position) pairs packed into 64 bits
            pairs = np.sort(key << wide | np.arange(n))
            order, key = pairs & ((1 << wide) - 1), pairs >> wide
        else:
            order = np.argsort(key)
            key = key[order]
        if packed >= depth or n < 2:
            return order
        new = np.r_[True, key[1:] != key[:-1]]
        if new.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        key = rank * (n + 1)
        if packed < n:
            key[:n - packed] += rank[packed:]
        small = 3 * wide <= 62
        packed *= 2
