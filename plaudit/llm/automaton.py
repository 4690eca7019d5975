"""Deterministic byte automata from regular expressions: subset construction and minimisation."""

from __future__ import annotations

import re._constants as sre
import re._parser as parser

import numpy as np


class Nfa:
    """Nondeterministic automaton: empty moves, and moves on sets of bytes."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, pattern: str) -> tuple[int, int]:
        """The start and end state of a regular expression over bytes."""
        return self._sequence(parser.parse(pattern.encode()), 0)

    def _sequence(self, items, flags: int) -> tuple[int, int]:
        start = end = self.state()
        for kind, value in items:
            first, last = self._item(kind, value, flags)
            self.empty[end].append(first)
            end = last
        return start, end

    def _item(self, kind, value, flags: int) -> tuple[int, int]:
        if kind is sre.SUBPATTERN:
            return self._sequence(value[3], (flags | value[1]) & ~value[2])
        if kind is sre.BRANCH:
            start, end = self.state(), self.state()
            for choice in value[1]:
                first, last = self._sequence(choice, flags)
                self.empty[start].append(first)
                self.empty[last].append(end)
            return start, end
        if kind is sre.MAX_REPEAT:
            least, most, body = value
            start = end = self.state()
            for _ in range(least):
                first, last = self._sequence(body, flags)
                self.empty[end].append(first)
                end = last
            if most is sre.MAXREPEAT:
                first, last = self._sequence(body, flags)
                self.empty[end].append(first)
                self.empty[last].append(end)
                return start, end
            skip = [end]
            for _ in range(most - least):
                first, last = self._sequence(body, flags)
                self.empty[end].append(first)
                end = last
                skip.append(end)
            for state in skip[:-1]:
                self.empty[state].append(end)
            return start, end
        start, end = self.state(), self.state()
        self.moves[start].append((self._bytes(kind, value, flags), end))
        return start, end

    @staticmethod
    def _bytes(kind, value, flags: int) -> frozenset[int]:
        if kind is sre.LITERAL:
            found = {value}
        elif kind is sre.NOT_LITERAL:
            found = set(range(256)) - {value}
        elif kind is sre.IN:
            found = set()
            for inner, part in value:
                if inner is sre.LITERAL:
                    found.add(part)
                elif inner is sre.RANGE:
                    found.update(range(part[0], part[1] + 1))
                elif inner is not sre.NEGATE:
                    raise ValueError(f"not supported: {inner}")
            if value[0][0] is sre.NEGATE:
                found = set(range(256)) - found
        else:
            raise ValueError(f"not supported: {kind}")
        if flags & sre.SRE_FLAG_IGNORECASE:
            found |= {b ^ 32 for b in found if 65 <= b <= 90 or 97 <= b <= 122}
        return frozenset(found)

    def reversed(self) -> Nfa:
        other = Nfa()
        other.empty = [[] for _ in self.empty]
        other.moves = [[] for _ in self.moves]
        for state, (empty, moves) in enumerate(zip(self.empty, self.moves)):
            for target in empty:
                other.empty[target].append(state)
            for symbols, target in moves:
                other.moves[target].append((symbols, state))
        return other

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for target in self.empty[todo.pop()]:
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
        return frozenset(seen)


class Dfa:
    """Transition array ``table[state, symbol class]``, byte classes, accepted rules as bits per state.

    State 0 is the start.
    """

    def __init__(self, table: np.ndarray, classes: np.ndarray, accepts: np.ndarray):
        self.table, self.classes, self.accepts = table, classes, accepts


def byte_classes(nfa: Nfa) -> tuple[np.ndarray, list[int]]:
    """Bytes that no move tells apart share a class; also one byte of every class."""
    signature: list[list[int]] = [[] for _ in range(256)]
    for number, symbols in enumerate({s for moves in nfa.moves for s, _ in moves}):
        for byte in symbols:
            signature[byte].append(number)
    names: dict[tuple[int, ...], int] = {}
    classes = np.array([names.setdefault(tuple(s), len(names)) for s in signature], dtype=np.uint8)
    return classes, [int(np.flatnonzero(classes == c)[0]) for c in range(len(names))]


def determinise(nfa: Nfa, start: list[int], ends: list[int], anywhere: bool) -> Dfa:
    """Subset construction. ``anywhere``: a match may start at every byte."""
    classes, members = byte_classes(nfa)
    origin = nfa.closure(start)
    number = {origin: 0}
    todo, table = [origin], []
    for subset in todo:
        row = []
        moves = [m for state in subset for m in nfa.moves[state]]
        for byte in members:
            targets = [t for symbols, t in moves if byte in symbols]
            after = nfa.closure(targets) | (origin if anywhere else frozenset())
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
        table.append(row)
    accepts = np.array([sum(1 << r for r, e in enumerate(ends) if e in subset) for subset in todo], dtype=np.int64)
    return minimise(Dfa(np.array(table, dtype=np.int32), classes, accepts))


def minimise(dfa: Dfa) -> Dfa:
    """Splits states by what they accept, then by where they lead, until nothing splits."""
    _, part = np.unique(dfa.accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([part, part[dfa.table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    # The start state becomes number 0.
    _, first = np.unique(part, return_index=True)
    order = np.argsort(first, kind="stable")
    rename = np.empty(len(order), dtype=np.int32)
    rename[order] = np.arange(len(order))
    keep = first[order]
    return Dfa(rename[part[dfa.table[keep]]], dfa.classes, dfa.accepts[keep])
