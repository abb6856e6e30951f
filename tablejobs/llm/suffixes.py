"""Suffix sorting and the Burrows-Wheeler transform of one bounded piece, in NumPy."""

from __future__ import annotations

import numpy as np


def _ranks(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    new = np.empty(len(keys), bool)
    new[0] = True
    sorted_keys = keys[order]
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=new[1:])
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new)
    return rank, int(new.sum())


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``symbols``; the last symbol must be a unique smallest 0.

    Prefix doubling, starting from keys of several packed symbols. Ranks are the same
    for suffixes that agree so far, so once all differ the order is final."""
    n = len(symbols)
    if n <= 1:
        return np.arange(n)
    bits = max(1, int(symbols.max()).bit_length())
    width = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for i in range(width):
        key <<= bits
        if i < n:
            key[:n - i] |= symbols[i:].astype(np.int64)
    order = np.argsort(key)
    rank, classes = _ranks(key, order)
    done = width
    while classes < n:
        key = rank * (n + 1)
        if done < n:
            key[:n - done] += rank[done:]
        # Only suffixes that still tie have to be sorted again.
        sorted_rank = rank[order]
        same = np.zeros(n, bool)
        same[1:] = sorted_rank[1:] == sorted_rank[:-1]
        tied = same.copy()
        tied[:-1] |= same[1:]
        places = np.flatnonzero(tied)
        some = order[places]
        order[places] = some[np.argsort(key[some])]
        rank, classes = _ranks(key, order)
        done *= 2
    return order


def bwt(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The symbol before each suffix, cyclically."""
    return symbols[order - 1]


class WaveletMatrix:
    """Rank and access over a sequence of small integers, one bit level at a time."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.ones: list[np.ndarray] = []      # ones before each place, per level from the top
        self.zeros: list[int] = []
        values = np.asarray(values)
        for b in range(self.bits - 1, -1, -1):
            bit = (values >> b) & 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=before[1:])
            self.ones.append(before)
            self.zeros.append(int(len(values) - before[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def _down(self, level: int, one: np.ndarray, i: np.ndarray) -> np.ndarray:
        ones = self.ones[level][i]
        return np.where(one, self.zeros[level] + ones, i - ones)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before place ``i`` (both arrays)."""
        first = np.zeros(len(symbol), np.int64)
        i = i.astype(np.int64)
        for level in range(self.bits):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            first, i = self._down(level, one, first), self._down(level, one, i)
        return i - first

    def access(self, i: np.ndarray) -> np.ndarray:
        """The symbols at places ``i``."""
        symbol, i = np.zeros(len(i), np.int64), i.astype(np.int64)
        for level in range(self.bits):
            one = self.ones[level][i + 1] > self.ones[level][i]
            symbol = symbol << 1 | one
            i = self._down(level, one, i)
        return symbol


class FMIndex:
    """Full-text index: a wavelet matrix over the transform and every
    ``SAMPLE``-th text position's place among the suffixes."""

    SAMPLE = 8

    def __init__(self, symbols: np.ndarray):
        """``symbols`` ends with a unique smallest 0."""
        order = suffix_array(symbols)
        self.n = len(symbols)
        self.wavelet = WaveletMatrix(bwt(symbols, order))
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=int(symbols.max()) + 1))])
        self.marked = order % self.SAMPLE == 0
        self.mark_rank = np.cumsum(self.marked) - 1
        self.samples = order[self.marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [lo, hi) of phrases (rows, padded at the end), found from their last symbol on."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for step in range(int(lengths.max(initial=0))):
            live = live[(lengths[live] > step) & (hi[live] > lo[live])] if step else live
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - step]
            known = symbol < len(self.starts) - 1
            hi[live[~known]] = lo[live[~known]]
            live, symbol = live[known], symbol[known]
            lo[live], hi[live] = (self.starts[symbol] + self.wavelet.rank(symbol, x[live]) for x in (lo, hi))
            live = np.arange(len(phrases)) if step == 0 else live
        return lo, np.maximum(lo, hi)

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes at ``places``: walk back to a sampled one."""
        found = np.empty(len(places), np.int64)
        at, which, steps = places.astype(np.int64), np.arange(len(places)), 0
        while len(at):
            here = self.marked[at]
            found[which[here]] = self.samples[self.mark_rank[at[here]]] + steps
            at, which = at[~here], which[~here]
            if len(at):
                symbol = self.wavelet.access(at)
                at = self.starts[symbol] + self.wavelet.rank(symbol, at)
                steps += 1
        return found
