"""Context-tree weighting over binary-decomposed bytes.

A byte is eight binary decisions; decision ``node`` (1, then 2 or 3, ... up to 255) has a tree of its own
over the preceding bytes, nearest first. A context's Krichevsky-Trofimov estimate from its counts is mixed,
half and half, with what its longer contexts say, at every depth; all counts being known, the mixture is
a fixed probability per decision and deepest known context.

Every context that occurs stays in its tree, however rare. Below contexts of ``SPLIT`` bytes the trees are
weighted apart, each from the keys of its own contexts alone; the decisions of shorter contexts, whose number
the alphabet bounds and not the corpus, are then weighted with the sums of what those say.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH = 6  # bytes; with the symbol they fit into 63 bits
END = 255  # in no UTF-8 text
SPLIT = 3


def stream_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with ``DEPTH`` end symbols before and after each; start and length (end included) of each."""
    gap = bytes([END]) * DEPTH
    content = np.frombuffer(gap + gap.join(texts) + gap, dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.cumsum(lengths + DEPTH) - lengths
    return content, starts, lengths + 1


def keys_of(content: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per symbol, the preceding bytes, nearest in the highest place, and the symbol in the lowest."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    # Eight bytes from every position on, as one little-endian number: the last byte is the highest.
    padded = np.concatenate([content, np.zeros(8, dtype=np.uint8)])
    ahead = np.ndarray(len(content) - DEPTH, dtype="<i8", buffer=padded, strides=(1,))
    key = ahead & ((1 << 8 * DEPTH) - 1)
    key <<= 8
    key |= content[DEPTH:]
    wanted = np.ones(len(key), dtype=bool)
    between = starts + lengths - DEPTH  # the end symbols after a text, but for its own
    for step in range(DEPTH - 1):
        wanted[between + step] = False
    return key[wanted]


def decisions(keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of a depth with a decision (context, then 8 bits of node), and how often it was 0 and 1."""
    context = (keys >> (8 * (DEPTH + 1 - depth))) << 8
    symbol = keys & 255
    names = np.concatenate([context | (1 << j) | (symbol >> (8 - j)) for j in range(8)])
    bits = np.concatenate([(symbol >> (7 - j)) & 1 for j in range(8)])
    names, place = np.unique(names, return_inverse=True)
    many = np.tile(counts, 8).astype(np.float64)
    ones = np.bincount(place, weights=many * bits, minlength=len(names)).astype(np.int64)
    zeros = np.bincount(place, weights=many * (1 - bits), minlength=len(names)).astype(np.int64)
    return names, zeros, ones


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, and back by the recurrence."""
    y = x + 8.0
    series = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    step = np.ones_like(y)
    for i in range(8):
        step = step * (x + i)
    return series - np.log(step)


def _kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1.0)


@dataclass(frozen=True)
class Tree:
    """Per depth, sorted decisions and the mixed probability of a 1 if no longer context is known."""

    names: list[np.ndarray]
    ones: list[np.ndarray]

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of the symbol of every key, given its context. Keys are sorted."""
        total = np.zeros(len(keys))
        symbol = keys & 255
        # A decision's counts are part of those of the decision before it, in every context.
        longest = np.full(len(keys), DEPTH, dtype=np.int8)
        for j in range(8):
            node = (1 << j) | (symbol >> (8 - j))
            chance = np.full(len(keys), 0.5)
            for depth in range(DEPTH, -1, -1):
                open_ = np.flatnonzero(longest == depth)
                names = self.names[depth]
                if not len(open_):
                    continue
                if not len(names):
                    longest[open_] -= 1
                    continue
                wanted = ((keys[open_] >> (8 * (DEPTH + 1 - depth))) << 8) | node[open_]
                place = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
                known = names[place] == wanted
                chance[open_[known]] = self.ones[depth][place[known]]
                longest[open_[~known]] -= 1
            bit = (symbol >> (7 - j)) & 1
            total += np.log(np.where(bit == 1, chance, 1 - chance))
        return total


def _parents(names: np.ndarray) -> np.ndarray:
    """The decisions of the contexts that are shorter by the farthest byte."""
    return ((names >> 16) << 8) | (names & 255)


def levels_of(keys: np.ndarray, counts: np.ndarray, low: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``decisions`` of the depths from ``low`` on."""
    levels = [decisions(keys, counts, DEPTH)]
    while len(levels) <= DEPTH - low:
        levels.insert(0, shorter(*levels[0])[:3])
    return levels


def shorter(names: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray | None = None) -> list[np.ndarray]:
    """Sorted decisions of the contexts shorter by a byte, and the sums over their children."""
    above, place = np.unique(_parents(names), return_inverse=True)
    sums = [np.bincount(place, weights=x, minlength=len(above)) for x in (zeros, ones)]
    more = [] if weighted is None else [np.bincount(place, weights=weighted, minlength=len(above))]
    return [above, *(x.astype(np.int64) for x in sums), *more]


@dataclass(frozen=True)
class Weights:
    """Per depth and decision: logarithm of the weighted probability, the own estimate's share of it, the estimate
    of what no longer context holds, and the place of the parent (from the second depth on)."""

    weighted: list[np.ndarray]
    share: list[np.ndarray]
    rest: list[np.ndarray]
    parents: list


def weigh(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], below: np.ndarray | None = None) -> Weights:
    """Weights of consecutive depths. ``below``: what longer contexts say about each decision of the last depth,
    which then hold all of its counts; without it the last depth has no longer contexts."""
    last = len(levels) - 1
    names = [level[0] for level in levels]
    weighted: list = [None] * len(levels)
    share: list = [None] * len(levels)
    rest: list = [None] * len(levels)
    parents = [None] + [np.searchsorted(names[d - 1], _parents(names[d])) for d in range(1, len(levels))]
    for depth in range(last, -1, -1):
        _, zeros, ones = (np.asarray(x, dtype=np.float64) for x in levels[depth])
        own = _kt_log(zeros, ones)
        if depth == last and below is None:
            weighted[depth], share[depth], rest[depth] = own, np.ones(len(own)), (ones + 0.5) / (zeros + ones + 1)
            continue
        if depth == last:
            deeper, rest[depth] = below, np.full(len(own), 0.5)
        else:
            parent, size = parents[depth + 1], len(own)
            left_zeros = zeros - np.bincount(parent, weights=levels[depth + 1][1], minlength=size)[:size]
            left_ones = ones - np.bincount(parent, weights=levels[depth + 1][2], minlength=size)[:size]
            deeper = np.bincount(parent, weights=weighted[depth + 1], minlength=size)[:size] + _kt_log(left_zeros, left_ones)
            rest[depth] = (left_ones + 0.5) / (left_zeros + left_ones + 1)
        weighted[depth] = np.logaddexp(own, deeper) - np.log(2)
        share[depth] = np.exp(own - np.log(2) - weighted[depth])
    return Weights(weighted, share, rest, parents)


def blend(levels: list, weights: Weights, mixed: np.ndarray | None = None, open_: np.ndarray | None = None) -> tuple:
    """Per depth the probability of a 1 if no longer context is known; then ``mixed`` and ``open_`` of the last depth.

    ``mixed``, ``open_``: for each decision of the first depth, what shorter contexts have given, and the weight left."""
    result = []
    for depth, (_, zeros, ones) in enumerate(levels):
        if depth:
            mixed, open_ = mixed[weights.parents[depth]], open_[weights.parents[depth]]
        elif mixed is None:
            mixed, open_ = np.zeros(len(zeros)), np.ones(len(zeros))
        mixed = mixed + open_ * weights.share[depth] * (ones + 0.5) / (zeros + ones + 1.0)
        open_ = open_ * (1 - weights.share[depth])
        result.append(np.clip(mixed + open_ * weights.rest[depth], 1e-12, 1 - 1e-12))
    return result, mixed, open_


def build(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Tree:
    """The tree from the decisions of all depths, with their counts, sorted by decision. Counts that are in no
    given longer context form one further child of their context."""
    return Tree([level[0] for level in levels], blend(levels, weigh(levels))[0])


@dataclass(frozen=True)
class Top:
    """Contexts shorter than ``SPLIT`` bytes: a tree of them, and what is mixed and left open at the longest."""

    tree: Tree
    mixed: np.ndarray
    open: np.ndarray

    def extended(self, keys: np.ndarray, counts: np.ndarray) -> Tree:
        """The whole tree for contexts that have their nearest ``SPLIT`` bytes in common with some of ``keys``;
        ``keys`` are sorted and hold all that have these bytes."""
        levels = levels_of(keys, counts, SPLIT)
        place = np.searchsorted(self.tree.names[-1], _parents(levels[0][0]))
        found, _, _ = blend(levels, weigh(levels), self.mixed[place], self.open[place])
        return Tree(self.tree.names + [level[0] for level in levels], self.tree.ones + found)


def contributions(keys: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Decisions of contexts of ``SPLIT - 1`` bytes, their counts, and what longer contexts among ``keys`` say."""
    levels = levels_of(keys, counts, SPLIT)
    return shorter(*levels[0], weigh(levels).weighted[0])


def top_of(names: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> Top:
    """From the sums of all ``contributions``, sorted by decision."""
    levels = [(names, zeros, ones)]
    while len(levels) < SPLIT:
        levels.insert(0, shorter(*levels[0])[:3])
    found, mixed, open_ = blend(levels, weigh(levels, below))
    return Top(Tree([level[0] for level in levels], found), mixed, open_)
