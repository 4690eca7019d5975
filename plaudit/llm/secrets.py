"""Secret scans with one deterministic automaton for all rules.

The rules' expressions become one nondeterministic automaton, and by subset construction and
minimisation one transition array that a match may enter at every byte. A block of texts is scanned in
step, one byte of every text at a time, all rules at once. Where a rule stops accepting, a match ends;
the reversed automaton of the rule runs back from there and gives its starts. A rule therefore has to
end in a run of one character class or in fixed text. Texts of more than ``LONG`` bytes are scanned one by one
with the same array. A match is measured only where it can be taken or added, so a text that is one long run of
a rule's characters takes time in proportion to its length.

Per rule, matches are taken from the left without overlap; those that fail the rule's least length are
dropped afterwards (``base``). Matches that overlap a taken one of their rule, but meet the least length
by themselves, are added to ``spans``, as are those of the further rules.

Null and empty texts have no spans. Positions count code points, the end is exclusive. Repeated rows are
scanned as given, empty tables give empty results, and input columns named as a result column are
replaced. Nothing is shuffled, and no text is cut.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from plaudit.llm.automaton import Nfa, determinise
from plaudit.llm.common import add_columns, texts_of


@dataclass(frozen=True)
class Rule:
    """``least``: fewest characters of a match, or of its group where a base rule has one."""

    kind: str
    pattern: str
    least: int
    base: bool = True


RULES = (
    Rule("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32}[0-9a-f]*", 32),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 40, base=False),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 15, base=False),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", 27, base=False),
)

LONG = 1 << 16

SPAN = StructType([
    StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
FIELDS = [StructField("base_spans", ArrayType(SPAN)), StructField("spans", ArrayType(SPAN))]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        nfa = Nfa()
        ends, starts = [], []
        for rule in rules:
            start, end = nfa.add(rule.pattern)
            starts.append(start)
            ends.append(end)
        self.dfa = determinise(nfa, starts, ends, anywhere=True)
        back = nfa.reversed()
        self.backward = [determinise(back, [e], [s], anywhere=False) for s, e in zip(starts, ends)]
        # Plain lists for walks that go byte by byte, and states that nothing leads out of.
        self.back_rows = [dfa.table.tolist() for dfa in self.backward]
        self.back_accepts = [(dfa.accepts != 0).tolist() for dfa in self.backward]
        self.stuck = [
            ((dfa.table == np.arange(len(dfa.table))[:, None]).all(axis=1) & (dfa.accepts == 0)).tolist()
            for dfa in self.backward]
        self.exact = [re.compile(rule.pattern.encode()) for rule in rules]
        # Accepting states get the highest numbers, so that one comparison finds them.
        order = np.argsort(self.dfa.accepts != 0, kind="stable")
        rename = np.empty(len(order), dtype=np.int32)
        rename[order] = np.arange(len(order))
        self.start = int(rename[0])
        self.accepts = self.dfa.accepts[order]
        self.accepting = int(np.count_nonzero(self.accepts == 0))
        width = self.dfa.table.shape[1]
        self.width = width
        self.table = (rename[self.dfa.table[order]]).astype(np.int32).ravel()
        self.rows = self.table.reshape(-1, width).tolist()
        self.accept_bits = self.accepts.tolist()

    def ends_of_one(self, text: bytes) -> dict[int, list[int]]:
        """Match ends by rule: where a rule accepts and does not at the next byte."""
        found: dict[int, list[int]] = {}

        def note(bits: int, place: int) -> None:
            for number in range(len(self.rules)):
                if bits >> number & 1:
                    found.setdefault(number, []).append(place)

        rows, bits, state, before = self.rows, self.accept_bits, self.start, 0
        for place, symbol in enumerate(text.translate(self.dfa.classes.tobytes())):
            state = rows[state][symbol]
            now = bits[state]
            if before & ~now:
                note(before & ~now, place)
            before = now
        note(before, len(text))
        return found

    def ends(self, texts: list[bytes]) -> dict[tuple[int, int], list[int]]:
        """Match ends by (text, rule), from one pass over the bytes."""
        found = self.ends_in_step([t if len(t) <= LONG else b"" for t in texts])
        for number, text in enumerate(texts):
            if len(text) > LONG:
                found.update({(number, rule): places for rule, places in self.ends_of_one(text).items()})
        return found

    def ends_in_step(self, texts: list[bytes]) -> dict[tuple[int, int], list[int]]:
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(-lengths, kind="stable")
        symbols = self.dfa.classes[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        offsets = (np.cumsum(lengths) - lengths)[order]
        longest = int(lengths.max(initial=0))
        # How many texts are longer than each step.
        active = len(texts) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
        state = np.full(len(texts), self.start, dtype=np.int32)
        where, when, what = [], [], []
        for step, many in enumerate(active.tolist()):
            now = state[:many]
            np.multiply(now, self.width, out=now)
            np.add(now, symbols[offsets[:many] + step], out=now, casting="unsafe")
            now[:] = self.table[now]
            hit = np.flatnonzero(now >= self.accepting)
            if len(hit):
                where.append(hit)
                when.append(np.full(len(hit), step + 1))
                what.append(self.accepts[now[hit]])
        found: dict[tuple[int, int], list[int]] = {}
        if not where:
            return found
        text, end, rules = order[np.concatenate(where)], np.concatenate(when), np.concatenate(what)
        for number in range(len(self.rules)):
            mine = np.flatnonzero((rules >> number) & 1)
            mine = mine[np.lexsort((end[mine], text[mine]))]
            at, place = text[mine], end[mine]
            if len(at):
                last = np.concatenate([(at[1:] != at[:-1]) | (place[1:] != place[:-1] + 1), [True]])
                for t, e in zip(at[last].tolist(), place[last].tolist()):
                    found.setdefault((t, number), []).append(e)
        return found

    def starts(self, text: bytes, rule: int, end: int) -> list[int]:
        """Starts of matches of a rule with this end."""
        rows, accepts, stuck = self.back_rows[rule], self.back_accepts[rule], self.stuck[rule]
        classes = self.backward[rule].classes.tolist()
        state, at, found = 0, end, []
        while at > 0 and not stuck[state]:
            at -= 1
            state = rows[state][classes[text[at]]]
            if accepts[state]:
                found.append(at)
        return found

    def spans(self, text: bytes, ends: dict[int, list[int]]) -> tuple[list[tuple], list[tuple]]:
        """Base spans and all spans, as (start, rule, end) in bytes."""
        base, every = [], []
        for number, places in ends.items():
            rule, exact = self.rules[number], self.exact[number]
            matches = sorted({s: e for e in places for s in self.starts(text, number, e)}.items())
            taken, covered = 0, set()
            for start, end in matches:
                fresh = start >= taken
                if not fresh and end in covered:
                    continue
                if fresh:
                    taken = end
                match = exact.match(text, start)
                if len(match.group(1 if rule.base and exact.groups else 0)) < rule.least:
                    continue
                if fresh and rule.base:
                    base.append((start, number, end))
                covered.add(end)
                every.append((start, number, end))
        return sorted(base), sorted(every)


def find_secrets(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, block_bytes: int = 32 << 20,
) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: kind, start and end, by start, then in the order of rules."""

    scanner = Scanner(rules)  # compiled once; tasks receive the arrays

    def make():
        def step(batch: pa.RecordBatch):
            texts = [t or b"" for t in texts_of(batch.column(0))]
            per_text: dict[int, dict[int, list[int]]] = {}
            for (number, rule), ends in scanner.ends(texts).items():
                per_text.setdefault(number, {})[rule] = ends
            base: list[list] = [[] for _ in texts]
            every: list[list] = [[] for _ in texts]
            for number, ends in per_text.items():
                content = np.frombuffer(texts[number], dtype=np.uint8)
                points = np.concatenate([[0], np.cumsum((content & 0xC0) != 0x80)])
                for out, found in zip((base, every), scanner.spans(texts[number], ends)):
                    out[number] = [
                        {"kind": rules[r].kind, "start": int(points[s]), "end": int(points[e])} for s, r, e in found]
            return base, every

        return step

    return add_columns(docs, [text], FIELDS, make, block_bytes)
