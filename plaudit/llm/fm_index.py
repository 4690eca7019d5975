"""FM-index over the words of one shard: suffix sorting, wavelet tree, backward search, sampled positions.

Symbols are small integers; 0 separates segments (a document's end, or a word no phrase has), and every
separator counts as a symbol of its own, in the order of positions. So suffixes never compare beyond
their segment, and positions are found without ever stepping over a separator.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(symbols)
    width = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    within = np.ones(n, dtype=bool)  # no separator among the symbols so far
    for step in range(width):
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: max(0, n - step)] = symbols[step:]
        key <<= bits
        np.add(key, ahead, out=key, where=within)
        within &= ahead != 0
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]]) | ~within[order]
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = group
    tied = ~head
    tied[:-1] |= ~head[1:]
    slots = np.flatnonzero(tied)
    depth = width
    while len(slots):
        suffixes = order[slots]
        key = rank[suffixes] * n + rank[suffixes + depth]
        again = np.argsort(key, kind="stable")
        suffixes, key = suffixes[again], key[again]
        order[slots] = suffixes
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[suffixes] = slots[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
        tied = ~head
        tied[:-1] |= ~head[1:]
        slots = slots[tied]
        depth *= 2
    return order


class WaveletTree:
    """Bit vectors of a sequence, most significant bit first, with running counts of ones."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        current = sequence
        for shift in range(bits - 1, -1, -1):
            ones = ((current >> shift) & 1).astype(bool)
            counts = np.zeros(len(current) + 1, dtype=np.int32)
            np.cumsum(ones, out=counts[1:])
            self.levels.append((shift, counts, len(current) - int(counts[-1])))
            current = np.concatenate([current[~ones], current[ones]])

    def descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where the prefixes of length ``places`` end in the last level, sorted by symbol."""
        for shift, counts, zeros in self.levels:
            ones = counts[places]
            places = np.where((symbols >> shift) & 1, zeros + ones, places - ones)
        return places

    def symbol_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols at ``places`` and their places in the last level."""
        symbols = np.zeros(len(places), dtype=np.int64)
        for shift, counts, zeros in self.levels:
            ones = counts[places]
            bit = counts[places + 1] - ones
            symbols |= bit.astype(np.int64) << shift
            places = np.where(bit, zeros + ones, places - ones)
        return symbols, places


class FmIndex:
    """Index of ``symbols``, whose last one is 0. Every ``sample``-th position is kept."""

    def __init__(self, symbols: np.ndarray, size: int, sample: int = 8):
        bits = max(1, int(size - 1).bit_length())
        order = suffix_order(symbols, bits)
        before = symbols[order - 1]  # of position 0 the last symbol, a separator
        self.tree = WaveletTree(before, bits)
        counts = np.bincount(symbols, minlength=size)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        every = np.arange(size, dtype=np.int64)
        self.origin = self.tree.descend(every, np.zeros(size, dtype=np.int64))
        sampled = (order % sample == 0) | (before == 0)
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.positions = order[sampled]

    def _step(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.first[symbols] + self.tree.descend(symbols, rows) - self.origin[symbols]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases, the rows of a matrix whose first ``lengths`` symbols count."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.first[-1], dtype=np.int64)
        for back in range(int(lengths.max(initial=0))):
            active = np.flatnonzero((lengths > back) & (low < high))
            symbols = phrases[active, lengths[active] - 1 - back]
            low[active] = self._step(symbols, low[active])
            high[active] = self._step(symbols, high[active])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows, by steps to the left until a sampled one."""
        rows = rows.copy()
        positions = np.empty(len(rows), dtype=np.int64)
        active, steps = np.arange(len(rows)), 0
        while len(active):
            at = rows[active]
            found = self.sampled[at + 1] > self.sampled[at]
            positions[active[found]] = self.positions[self.sampled[at[found]]] + steps
            active = active[~found]
            symbols, places = self.tree.symbol_at(rows[active])
            rows[active] = self.first[symbols] + places - self.origin[symbols]
            steps += 1
        return positions
