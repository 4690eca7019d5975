"""Double-array tries of phrases, and the step that runs all word starts of a block through one.

A state's child for a byte lies in the slot ``base[state] + byte`` if ``check`` of that slot names the
state. ``accept`` holds the number of the phrase that ends in a state, or -1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK, BREAK = 32, 10
#: Lower-cases A-Z, turns a tab into a blank and every mark that ends a piece into a line feed.
_MAP = bytes(
    b + 32 if 65 <= b <= 90 else BLANK if b == 9 else BREAK if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_EMPTY = -1
_ROOT = -2


@dataclass
class Words:
    """Words of a block of texts: ``raw`` has one blank, or line feed at a piece's end, after each of them."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    last: np.ndarray  # whether the word ends its piece


def words_in(raw: np.ndarray) -> Words:
    """Words of what :func:`plain_words` gives."""
    end = np.flatnonzero((raw == BLANK) | (raw == BREAK))
    start = np.empty_like(end)
    start[:1] = 0
    start[1:] = end[:-1] + 1
    return Words(raw, start, end, raw[end] == BREAK)


def plain_words(texts: list[bytes]) -> np.ndarray:
    """The words of texts, lower-cased, each with a blank after it, or a line feed where its piece ends."""
    joined = b"\n".join(texts) + b"\n"
    given = np.frombuffer(joined.translate(_MAP), dtype=np.uint8)
    inside = (given != BLANK) & (given != BREAK)
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    begin, stop = edge[0::2], edge[1::2]
    breaks = np.cumsum(given == BREAK, dtype=np.int32)
    last = np.empty(len(begin), dtype=bool)
    if len(begin):
        last[:-1] = breaks[begin[1:]] > breaks[stop[:-1] - 1]
        last[-1] = True
    length = stop - begin
    end = np.cumsum(length + 1) - 1
    raw = np.empty(int(length.sum()) + len(begin), dtype=np.uint8)
    content = np.ones(len(raw), dtype=bool)
    content[end] = False
    raw[content] = given[inside]
    raw[end] = np.where(last, BREAK, BLANK)
    return raw


@dataclass
class Trie:
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    roots: dict[bytes, int]  # by language
    phrases: int

    def count(self, words: Words, language: bytes, counts: np.ndarray, weights: np.ndarray | None = None) -> None:
        """Adds to ``counts`` the occurrences of every phrase of a language.

        All starts advance by one byte at a time. At the end of a word an accepting state counts, and a start
        whose piece goes on takes the blank as its next byte. With ``weights``, one for each piece, only the
        starts of pieces advance and count so often, and a first word counts only if it is the whole piece.
        """
        raw, base, check, accept = words.raw, self.base, self.check, self.accept
        root = self.roots.get(language)
        if root is None:
            return
        place = words.start
        if weights is not None:
            place = place[np.concatenate([[True], words.last[:-1]])]
            first = np.ones(len(place), dtype=bool)
        state = np.full(len(place), root, dtype=np.int32)
        while len(place):
            symbol = raw[place]
            edge = (symbol == BLANK) | (symbol == BREAK)
            counted = edge if weights is None else edge & ~(first & (symbol == BLANK))
            met = accept[state[counted]]
            some = met >= 0
            if some.any():
                tally = np.bincount(met[some], weights=None if weights is None else weights[counted][some])
                counts[:len(tally)] += tally.astype(np.int64)
            follow = base[state] + symbol
            on = (check[follow] == state) & (symbol != BREAK)
            if weights is not None:
                weights, first = weights[on], (first & ~edge)[on]
            place, state = place[on] + 1, follow[on]


def _nodes(joined: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent and byte of every node but the root, in order of depth, and the node in which each key ends.

    Keys are sorted; ``joined`` has their bytes one after another.
    """
    offset = np.cumsum(length) - length
    node = np.zeros(len(length), dtype=np.int32)
    same = np.ones(len(length), dtype=bool)  # as the key before, down to this depth
    same[:1] = False
    parents, symbols = [], []
    made, depth = 1, 0
    active = np.flatnonzero(length > 0)
    while len(active):
        symbol = joined[offset[active] + depth]
        before = np.empty(len(active), dtype=np.int16)
        before[:1] = -1
        before[1:] = np.where(active[1:] == active[:-1] + 1, symbol[:-1], -1)
        same[active] &= before == symbol
        new = ~same[active]
        parents.append(node[active][new])
        symbols.append(symbol[new])
        node[active] = made - 1 + np.cumsum(new)
        made += int(new.sum())
        depth += 1
        active = active[length[active] > depth]
    if not parents:
        return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.uint8), node
    return np.concatenate(parents), np.concatenate(symbols), node


def _place(sizes: np.ndarray, symbols: np.ndarray, spare: float = 1.3) -> tuple[np.ndarray, int]:
    """Base of every row of children, so that no two rows share a slot, and the number of slots.

    ``symbols`` lists the children of row after row. Big rows go first, all rows of about one size together:
    each proposes a place, those that meet no other keep it and the rest propose again. Rows of one child
    then fill the free slots.
    """
    rng = np.random.default_rng(1)
    slots = int(len(symbols) * spare) + 1024
    used = np.zeros(slots, dtype=bool)
    used[0] = True
    first = np.cumsum(sizes) - sizes
    base = np.zeros(len(sizes), dtype=np.int64)
    for low, high in ((64, 257), (32, 64), (16, 32), (8, 16), (4, 8), (3, 4), (2, 3)):
        pending = np.flatnonzero((sizes >= low) & (sizes < high))
        while len(pending):
            if used.mean() > 0.75:
                slots = int(slots * 1.25)
                used = np.concatenate([used, np.zeros(slots - len(used), dtype=bool)])
            many = sizes[pending]
            begin = np.cumsum(many) - many
            child = np.repeat(first[pending] - begin, many) + np.arange(int(many.sum()))
            proposed = rng.integers(1, slots - 256, len(pending))
            slot = np.repeat(proposed, many) + symbols[child]
            claim = np.repeat(np.arange(len(pending)), many)
            owner = np.full(slots, -1, dtype=np.int32)
            owner[slot] = claim
            bad = np.logical_or.reduceat(used[slot] | (owner[slot] != claim), begin)
            base[pending[~bad]] = proposed[~bad]
            used[slot[~np.repeat(bad, many)]] = True
            if bad.mean() > 0.98:  # too full for rows of this size
                slots = int(slots * 1.25)
                used = np.concatenate([used, np.zeros(slots - len(used), dtype=bool)])
            pending = pending[bad]
    single = np.flatnonzero(sizes == 1)
    free = np.flatnonzero(~used[256:slots - 256]) + 256
    if len(free) < len(single):
        free = np.concatenate([free, np.arange(slots, slots + len(single) - len(free))])
        slots = int(free[-1]) + 1
    base[single] = free[:len(single)] - symbols[first[single]]
    return base, slots + 256


def build(languages: pa.Array, phrases: pa.Array) -> Trie:
    """The trie of distinct (language, phrase) keys; a phrase's number is its place in the arrays."""
    binary = languages.cast(pa.binary())
    names = sorted(binary.unique().to_pylist())
    paths = pc.binary_join_element_wise(binary, phrases.cast(pa.binary()), pa.scalar(b"\n", pa.binary()))
    paths = pa.concat_arrays([paths, pa.array([name + b"\n" for name in names], pa.binary())])
    order = pc.sort_indices(paths)
    sorted_paths = paths.take(order)
    order = order.to_numpy()
    length = pc.binary_length(sorted_paths).to_numpy().astype(np.int64)
    content = sorted_paths.buffers()[2]
    joined = np.frombuffer(content, dtype=np.uint8)[:int(length.sum())] if content else np.empty(0, dtype=np.uint8)
    parent, symbol, last = _nodes(joined, length)
    del paths, sorted_paths, joined
    ending = np.empty(len(order), dtype=np.int32)
    ending[order] = last
    by_parent = np.lexsort((symbol, parent))
    row_of, sizes = np.unique(parent, return_counts=True)
    row_base, slots = _place(sizes, symbol[by_parent].astype(np.int64))
    del by_parent
    node_base = np.zeros(len(parent) + 1, dtype=np.int32)
    node_base[row_of] = row_base
    slot = np.zeros(len(parent) + 1, dtype=np.int32)  # the root lies in slot 0
    slot[1:] = node_base[parent] + symbol
    base = np.zeros(slots, dtype=np.int32)
    check = np.full(slots, _EMPTY, dtype=np.int32)
    accept = np.full(slots, -1, dtype=np.int32)
    base[slot] = node_base
    check[0] = _ROOT
    check[slot[1:]] = slot[parent]
    many = len(phrases)
    accept[slot[ending[:many]]] = np.arange(many)
    return Trie(base, check, accept, {name: int(slot[ending[many + i]]) for i, name in enumerate(names)}, many)
