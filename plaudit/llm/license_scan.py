"""License scans by patience alignment of texts with license templates.

A template is aligned with a window of text a little longer than itself: words that occur once in both
are anchors, the longest increasing subsequence of anchors is kept, and the gaps between them are aligned
the same way. Coverage is the share of the template's words that are matched in order.

Coverage alone does not tell siblings apart, so a template also names the words that make it this license
(its name and version): each has to be among the matched ones. Words that would make it another license of its
family (``lesser``, another version, ``nc``) must not stand inside the matched span.

A window can only match if it holds the needed words, and that share of the template's words, in any
order; running counts find all such windows of a whole text, and each of them is aligned. Of windows that follow
each other without such a gap the best is the match, the first of equals; it ends the search for this
template up to its last word. Where matches of several templates overlap, the one with the most matched words
stays, of equals the one with the higher coverage, then the earlier, then the one with the smaller name, then the
template listed first.

Null and empty texts have no words and no matches. Repeated rows are scanned as given, empty tables give
empty results, and input columns named as a result column are replaced. A template without words matches
nothing. Nothing is shuffled, and no text is cut.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from plaudit.llm.common import add_columns, plain, plain_words, texts_of


@dataclass(frozen=True)
class Template:
    """``needs``: words that have to be matched; ``bars``: words that must not stand between them."""

    license: str
    text: str
    needs: str = ""
    bars: str = ""


# Names of licenses, notices and whole texts by which works declare them.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction")
_MIT_REST = (
    ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met")
_BSD_CONDITIONS = (
    ": Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. ")
_BSD_REST = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.")
_GNU = "lesser library affero 1 2 3"
_CC = "nc sa nd noncommercial commercial sharealike share noderivatives noderivs derivatives 1 2 3 4"


def _without(bars: str, needs: str) -> str:
    return " ".join(w for w in bars.split() if w not in needs.split())


def _gnu(name: str, title: str, needs: str, major: str) -> list[Template]:
    bars = _without(_GNU, needs)
    return [
        Template(name, f"licensed under the GNU {title} General Public License, version {major}.", needs, bars),
        Template(name, f"This work is licensed under the GNU {title} General Public License, version {major}.", needs, bars),
        Template(name, f"GNU {title} General Public License as published by the Free Software Foundation, either version "
                 f"{major} of the License, or (at your option) any later version", needs, bars),
        Template(name, "This program is free software: you can redistribute it and/or modify it under the terms of the "
                 f"GNU {title} General Public License as published by the Free Software Foundation, either version {major} "
                 "of the License", needs, bars)]


def _cc(name: str, short: str, title: str, needs_short: str, needs_title: str) -> list[Template]:
    return [
        Template(name, f"Licensed under CC {short} 4.0.", f"cc by {needs_short} 4", _without(_CC, f"{needs_short} 4")),
        Template(name, f"This work is licensed under a Creative Commons {title} 4.0 International License.",
                 f"creative commons attribution {needs_title} 4", _without(_CC, f"{needs_title} 4"))]


TEMPLATES = (
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2", "1"),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
             "except in compliance with the License. You may obtain a copy of the License at "
             "http://www.apache.org/licenses/LICENSE-2.0", "apache 2", "1"),
    Template("BSD", _BSD_GRANT, "redistribution source binary"),
    Template("BSD-2-Clause", _BSD_GRANT + _BSD_CONDITIONS + _BSD_REST, "redistribution disclaimer", "neither endorse"),
    Template("BSD-3-Clause", _BSD_GRANT + _BSD_CONDITIONS + _BSD_NAMES + _BSD_REST, "redistribution neither endorse"),
    Template("BSD-2-Clause", "Licensed under the BSD 2-Clause License.", "bsd 2", "3 4"),
    Template("BSD-3-Clause", "Licensed under the BSD 3-Clause License.", "bsd 3", "2 4"),
    *_cc("CC-BY-4.0", "BY", "Attribution", "", ""),
    *_cc("CC-BY-SA-4.0", "BY-SA", "Attribution-ShareAlike", "sa", "sharealike"),
    *_cc("CC-BY-NC-4.0", "BY-NC", "Attribution-NonCommercial", "nc", "noncommercial"),
    *_cc("CC-BY-ND-4.0", "BY-ND", "Attribution-NoDerivatives", "nd", "noderivatives"),
    *_cc("CC-BY-NC-SA-4.0", "BY-NC-SA", "Attribution-NonCommercial-ShareAlike", "nc sa", "noncommercial sharealike"),
    *_cc("CC-BY-NC-ND-4.0", "BY-NC-ND", "Attribution-NonCommercial-NoDerivatives", "nc nd", "noncommercial noderivatives"),
    *_gnu("GPL-2.0", "", "gnu 2", "2"),
    *_gnu("GPL-3.0", "", "gnu 3", "3"),
    *_gnu("LGPL-2.1", "Lesser", "gnu lesser 2 1", "2.1"),
    *_gnu("LGPL-3.0", "Lesser", "gnu lesser 3", "3"),
    *_gnu("AGPL-3.0", "Affero", "gnu affero 3", "3"),
    Template("ISC", _ISC, "fee appear"),
    Template("ISC", "Released under the ISC License.", "isc"),
    Template("MIT", "Released under the MIT License.", "mit"),
    Template("MIT", _MIT_GRANT, "restriction charge"),
    Template("MIT", _MIT_GRANT + _MIT_REST, "restriction sublicense"),
    Template("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2", "1"),
)
BREAK = b"."
MATCH = StructType([
    StructField("license", StringType()), StructField("start", LongType()), StructField("end", LongType()),
    StructField("coverage", DoubleType())])
FIELDS = [StructField("n_words", LongType()), StructField("matches", ArrayType(MATCH))]


def increasing(values: Sequence[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by piles of patience."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int | None] = []
    for index, value in enumerate(values):
        pile = bisect_left(tops, value)
        if pile == len(tops):
            tops.append(value)
            last.append(index)
        else:
            tops[pile], last[pile] = value, index
        before.append(last[pile - 1] if pile else None)
    chain = []
    at = last[-1] if last else None
    while at is not None:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def align(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Matched positions of two sequences, ascending in both."""
    found = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        low_a, high_a, low_b, high_b = todo.pop()
        while low_a < high_a and low_b < high_b and a[low_a] == b[low_b]:
            found.append((low_a, low_b))
            low_a, low_b = low_a + 1, low_b + 1
        while low_a < high_a and low_b < high_b and a[high_a - 1] == b[high_b - 1]:
            high_a, high_b = high_a - 1, high_b - 1
            found.append((high_a, high_b))
        many_a, many_b = Counter(a[low_a:high_a]), Counter(b[low_b:high_b])
        place = {b[i]: i for i in range(low_b, high_b) if many_b[b[i]] == 1}
        anchors = [(i, place[a[i]]) for i in range(low_a, high_a) if many_a[a[i]] == 1 and a[i] in place]
        if not anchors:
            continue
        anchors = [anchors[i] for i in increasing([j for _, j in anchors])]
        found += anchors
        for (i, j), (next_i, next_j) in zip([(low_a - 1, low_b - 1), *anchors], [*anchors, (high_a, high_b)]):
            if next_i > i + 1 and next_j > j + 1:
                todo.append((i + 1, next_i, j + 1, next_j))
    return sorted(found)


@dataclass(frozen=True)
class Known:
    """A template in numbers of words; ``size`` is the length of its windows."""

    license: str
    words: list[int]
    size: int
    needs: frozenset[int]
    bars: frozenset[int]


class Scanner:
    def __init__(self, templates: Sequence[Template], coverage: float):
        self.coverage = coverage
        self.vocabulary: dict[bytes, int] = {BREAK: -1}
        self.templates: list[Known] = []
        for template in templates:
            words, needs, bars = (self._numbers(t) for t in (template.text, template.needs, template.bars))
            if words:
                self.templates.append(Known(
                    template.license, words, len(words) + len(words) // 4 + 2, frozenset(needs), frozenset(bars)))

    def _numbers(self, text: str) -> list[int]:
        return [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in plain_words(text.encode())]

    def words(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Template words of all texts (others are 0), and where each text starts and ends."""
        every = (b" " + BREAK + b" ").join(plain(t or b"") for t in texts).split()
        symbols = np.fromiter(map(self.vocabulary.get, every, repeat(0)), dtype=np.int32, count=len(every))
        ends = np.append(np.flatnonzero(symbols == -1), len(symbols))
        return symbols, np.concatenate([[0], ends[:-1] + 1]), ends

    def candidates(self, symbols: np.ndarray, known: Known) -> np.ndarray:
        """Starts, on a word of the template, of windows with its needed words and enough of its words."""
        wanted = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        wanted[known.words] = True
        if known.needs:  # most blocks of texts lack one of them
            present = np.zeros(len(self.vocabulary) + 1, dtype=bool)
            present[symbols] = True
            if not present[list(known.needs)].all():
                return np.zeros(0, dtype=np.int64)
        places = np.flatnonzero(wanted[symbols])
        many = np.searchsorted(places, places + known.size) - np.arange(len(places))
        places = places[many >= self.coverage * len(known.words) - 1e-9]
        for word in sorted(known.needs):
            if not len(places):
                break
            at = np.flatnonzero(symbols == word)
            following = np.append(at, np.iinfo(np.int64).max)[np.searchsorted(at, places)]
            places = places[following < places + known.size]
        return places

    def aligned(self, known: Known, window: list[int]) -> tuple[int, int, int] | None:
        """First and last matched word of a window and the number of matched ones, if it is a match."""
        pairs = align(known.words, window)
        if len(pairs) < self.coverage * len(known.words) - 1e-9:
            return None
        if not known.needs <= {known.words[i] for i, _ in pairs}:
            return None
        first, last = pairs[0][1], pairs[-1][1]
        taken = {j for _, j in pairs}
        if any(window[j] in known.bars for j in range(first, last) if j not in taken):
            return None
        return first, last + 1, len(pairs)

    def scan(self, texts: list[bytes | None]) -> tuple[list[int], list[list[tuple]]]:
        symbols, starts, ends = self.words(texts)
        found: list[list[tuple]] = [[] for _ in texts]
        for number, known in enumerate(self.templates):
            best, done = None, 0
            places = self.candidates(symbols, known)
            texts_at = np.searchsorted(starts, places, side="right") - 1

            def keep(match, known=known, number=number):
                text, start, end, many = match
                found[text].append((
                    -many, -many / len(known.words), start - int(starts[text]), known.license, number,
                    end - int(starts[text])))

            for place, text in zip(places.tolist(), texts_at.tolist()):
                if best is not None and (place >= best[2] or text != best[0]):
                    keep(best)
                    best, done = None, best[2]
                if place < done:
                    continue
                match = self.aligned(known, symbols[place:min(place + known.size, int(ends[text]))].tolist())
                if match and (best is None or match[2] > best[3]):
                    best = (text, place + match[0], place + match[1], match[2])
            if best is not None:
                keep(best)
        return (ends - starts).tolist(), [without_overlaps(f) for f in found]


def without_overlaps(matches: list[tuple]) -> list[tuple[str, int, int, float]]:
    """The best matches of a text that no better one overlaps, as (license, start, end, coverage) by position."""
    kept_starts: list[int] = []
    kept: list[tuple[str, int, int, float]] = []
    for _, coverage, start, name, _, end in sorted(matches):
        at = bisect_left(kept_starts, end)  # the last one that starts before this one's end
        if at == 0 or kept[at - 1][2] <= start:
            kept_starts.insert(at, start)
            kept.insert(at, (name, start, end, -coverage))
    return kept


def find_licenses(
    docs: DataFrame, text: str = "text", templates: Sequence[Template] = TEMPLATES, coverage: float = 0.8,
) -> DataFrame:
    """``docs`` with ``n_words`` and ``matches`` (license, word positions, coverage), by position."""
    scanner = Scanner(templates, coverage)

    def make():
        def step(batch: pa.RecordBatch):
            counts, found = scanner.scan(texts_of(batch.column(0)))
            return counts, [
                [{"license": n, "start": s, "end": e, "coverage": c} for n, s, e, c in matches] for matches in found]

        return step

    return add_columns(docs, [text], FIELDS, make)
