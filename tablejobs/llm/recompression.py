"""A run-length grammar of many sequences by recompression, and its common extensions.

Rounds alternate two replacements over all sequences at once. Block compression
turns every maximal block ``a a ... a`` into one symbol for (a, length); pair
compression splits the symbols into left and right ones and turns every
left-right pair into one symbol. Both look at nothing but the symbols, so equal
stretches become equal symbols wherever they stand, but for a few at their
edges. Names are given by sorting the replaced pairs: two symbols are equal
exactly when what they stand for is equal, no hash is involved.

A common extension is found by climbing while symbols agree and both places are
at the edge of their parents (or get there by one equal symbol or block), and by
descending from the first difference: a constant number of steps per level, for
all asked pairs at once.
"""

from __future__ import annotations

import numpy as np

#: What separates sequences; never replaced, equal to no other symbol.
SEPARATOR = 0
#: Partitions of the symbols tried in one round of pair compression.
TRIES = 4


class Level:
    """Symbols of a level and how they are grouped into the next one's."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, blocks: bool):
        self.symbols = symbols
        #: First child of each parent, then the number of children.
        self.first = np.append(first, len(symbols)).astype(np.int32)
        starts = np.zeros(len(symbols), np.int32)
        starts[first] = 1
        self.up = np.cumsum(starts, dtype=np.int32) - 1
        self.blocks = blocks


def _sides(symbols: np.ndarray, salt: int) -> np.ndarray:
    """0 or 1 by symbol: which side of a pair it may be."""
    x = (symbols.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)).astype(np.uint8) & 1


class Grammar:
    """``symbols``: sequences of positive numbers, with a separator before the
    first, between two and after the last."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[Level] = []
        current = symbols.astype(np.int64)
        sequences = int(np.count_nonzero(current == SEPARATOR))
        name, salt = int(current.max(initial=0)) + 1, 1
        while len(current) > 3 * sequences:
            before = len(current)
            current, name = self._blocks(current, name)
            current, name, salt = self._pairs(current, name, salt)
            if len(current) == before:
                break
        self.top = current

    def _name(self, current: np.ndarray, first: np.ndarray, replaced: np.ndarray, key: np.ndarray,
              name: int, blocks: bool) -> tuple[np.ndarray, int]:
        """The next level, in which the parents ``replaced`` are named by their ``key``."""
        self.levels.append(Level(current, first, blocks))
        above = current[first]
        distinct, number = np.unique(key, return_inverse=True)
        above[replaced] = name + number
        return above, name + len(distinct)

    def _blocks(self, current: np.ndarray, name: int) -> tuple[np.ndarray, int]:
        start = np.ones(len(current), bool)
        start[1:] = (current[1:] != current[:-1]) | (current[1:] == SEPARATOR)
        first = np.flatnonzero(start)
        if len(first) == len(current):
            return current, name
        length = np.diff(np.append(first, len(current)))
        replaced = np.flatnonzero(length > 1)
        key = current[first[replaced]] * (int(length.max()) + 1) + length[replaced]
        return self._name(current, first, replaced, key, name, True)

    def _pairs(self, current: np.ndarray, name: int, salt: int) -> tuple[np.ndarray, int, int]:
        here, after = current[:-1], current[1:]
        words = (here != SEPARATOR) & (after != SEPARATOR)
        at = np.zeros(0, np.int64)
        for _ in range(TRIES):
            side = _sides(current, salt)
            salt += 1
            differ = words & (side[:-1] != side[1:])
            for left in (0, 1):
                found = np.flatnonzero(differ & (side[:-1] == left))
                at = found if len(found) > len(at) else at
            if 4 * len(at) >= np.count_nonzero(words):
                break
        if not len(at):
            return current, name, salt
        start = np.ones(len(current), bool)
        start[at + 1] = False
        first = np.flatnonzero(start)
        replaced = np.searchsorted(first, at)
        return *self._name(current, first, replaced, here[at] * name + after[at], name, False), salt

    def extend(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many symbols from the places ``a`` on equal those from ``b`` on, going
        forward (``step`` 1) or backward (-1). Both places of a pair are different and
        in the same sequence, so that it is the separator that ends the longest match."""
        start, a, b = a, a.astype(np.int64), b.astype(np.int64)
        height = len(self.levels)
        peak = np.full(len(a), height)
        live = np.arange(len(a))
        for k, level in enumerate(self.levels):
            if not len(live):
                break
            x, y = a[live], b[live]
            px, py = level.up[x], level.up[y]
            if step > 0:
                left_x, left_y = level.first[px + 1] - x, level.first[py + 1] - y
                edge = (level.first[px] == x) & (level.first[py] == y)
            else:
                left_x, left_y = x - level.first[px] + 1, y - level.first[py] + 1
                edge = (level.first[px + 1] - 1 == x) & (level.first[py + 1] - 1 == y)
            same = level.symbols[x] == level.symbols[y]
            move = np.where(same & ~edge, np.minimum(left_x, left_y), 0) * step
            x, y = x + move, y + move
            climbs = same & (edge | (left_x == left_y))
            peak[live[~climbs]] = k
            a[live], b[live] = x, y
            live = live[climbs]
            a[live], b[live] = level.up[x[climbs]], level.up[y[climbs]]
        while len(live):
            live = live[self.top[a[live]] == self.top[b[live]]]
            a[live] += step
            b[live] += step
        for k in range(height - 1, -1, -1):
            down = np.flatnonzero(peak > k)
            if not len(down):
                continue
            level = self.levels[k]
            px, py = a[down], b[down]
            if step > 0:
                x, y = level.first[px], level.first[py]
            else:
                x, y = level.first[px + 1] - 1, level.first[py + 1] - 1
            size = np.minimum(level.first[px + 1] - level.first[px], level.first[py + 1] - level.first[py]) \
                if level.blocks else 1
            move = np.where(level.symbols[x] == level.symbols[y], size, 0) * step
            a[down], b[down] = x + move, y + move
        return (a - start) * step
