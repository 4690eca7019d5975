"""Personal data: exact patterns, and what a skip-chain conditional random field adds to them.

``base`` spans are the leftmost non-overlapping matches of four patterns (email, ip, card, phone); matches that
fail their rule are dropped. The field then labels all tokens that hold two digits or more, an ``@``, a plus
before a digit, or a written-out "at" or "dot" in brackets. Tokens of one number or address, wherever they
stand in a document, share potentials, so that a telephone number without its plus or an address with
``[at]`` is found with more certainty where the plain form stands elsewhere. A run of tokens of one label with
a probability of ``CERTAIN`` or more is added if it holds a well-formed value of its kind and touches no base
span.

The field learns on the driver from at most ``SAMPLE`` documents of at most ``SAMPLE_CHARS`` characters, drawn
by hash, whose base spans are the labels. Each is also shown with its values rewritten into forms that the
patterns miss, and with values made invalid. Everything else covers whole texts of all documents.

Null and empty texts have no spans. Positions count code points, the end is exclusive. Repeated rows are
scanned as given, an empty table gives an empty result, and columns named as a result column are replaced.
Nothing is shuffled. A task needs about 400 bytes per candidate token of the documents it holds at once, so a
text of many megabytes that is all numbers needs that much by itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, LongType, StringType, StructField, StructType

from plaudit.llm.common import add_columns, texts_of
from plaudit.llm.skip_chain import Graph, Model, fit

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)  # 0 is none
CERTAIN = 0.5
SAMPLE = 1000
SAMPLE_CHARS = 16384
BLOCK_BYTES = 2 << 20

SPAN = StructType([
    StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
FIELDS = [StructField("base_spans", ArrayType(SPAN)), StructField("spans", ArrayType(SPAN))]

Span = tuple[int, int, int]  # start, kind, end in bytes

# --- base patterns ------------------------------------------------------------------------------

_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: Matches of the three number patterns lie inside these stretches.
_ZONE = re.compile(rb"[0-9+][0-9 ().+-]*+")
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NO_DIGIT = bytes(set(range(256)) - set(b"0123456789"))


def digits_of(text: bytes) -> bytes:
    return text.translate(None, _NO_DIGIT)


def luhn(digits: bytes) -> bool:
    values = [d - 48 for d in reversed(digits)]
    return sum(values[0::2] + [2 * d - 9 * (d > 4) for d in values[1::2]]) % 10 == 0


def small_parts(parts: list[bytes]) -> bool:
    """Whether all are numbers up to 255, with any leading zeros."""
    return all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in parts)


def emails(text: bytes) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern: a run of local characters before an ``@`` and a domain with a dot after it."""
    taken, at = 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            taken = domain.end()
            yield start, taken
        # The next address may start in what a failed domain left over, but not before this sign.
        taken = max(taken, at + 1)
        at = text.find(b"@", taken)


def base_matches(text: bytes) -> tuple[list[Span], list[Span]]:
    """Start, kind and end of the pattern matches that pass, and of those that fail, by start, then kind."""
    found: list[Span] = [(start, 0, end) for start, end in emails(text)]
    failed: list[Span] = []
    for zone in _ZONE.finditer(text):
        low, high = zone.span()
        if high - low < 7:  # shorter than any kind
            continue
        stretch = zone.group()
        if stretch.count(b".") > 2:
            for m in _IP.finditer(text, low, high):
                (found if small_parts(m.group().split(b".")) else failed).append((m.start(), 1, m.end()))
        if high - low >= 14:
            for m in _CARD.finditer(text, low, high):
                digits = digits_of(m.group())
                if len(digits) >= 14:
                    (found if len(digits) <= 19 and luhn(digits) else failed).append((m.start(), 2, m.end()))
        if b"+" in stretch:
            for m in _PHONE.finditer(text, low, high):
                (found if 10 <= len(digits_of(m.group())) <= 15 else failed).append((m.start(), 3, m.end()))
    return sorted(found), sorted(failed)


def base_spans(text: bytes) -> list[Span]:
    return base_matches(text)[0]


# --- candidate tokens ---------------------------------------------------------------------------

_FORM = re.compile(rb"[\[({](?:at|dot|\.|@)[\])}]", re.IGNORECASE)
_AT_FORM = re.compile(rb"[\[({](?:at|@)[\])}]", re.IGNORECASE)
_DOT_FORM = re.compile(rb"[\[({](?:dot|\.)[\])}]", re.IGNORECASE)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MARK = np.zeros(256, dtype=np.int8)
_MARK[48:58] = 1
_MARK[ord("@")] = 2
_WORDS_BEFORE = 16  # classes of the word before a token
_SEPARATED = re.compile(rb"[0-9][^0-9]+[0-9]")

_BUCKETS = (1, 4, 5, 7, 8, 10, 11, 13, 14, 16, 17, 20)  # digits of a token and of its run
_FEATURES = {
    name: number for number, name in enumerate([
        "any", "at", "at form", "dot form", "plus", "bracket", "dash", "slash", "equals or colon", "underline",
        "no letters", "few letters", "many letters", "hex letters", "domain", "four small parts", "run luhn", "run plus",
        "run separated", "run of one", "long",
        *[f"digits {n}" for n in range(len(_BUCKETS) + 1)], *[f"run digits {n}" for n in range(len(_BUCKETS) + 1)],
        *[f"dots {n}" for n in range(5)], *[f"before {n}" for n in range(_WORDS_BEFORE)]])}
FEATURES = len(_FEATURES)
ACTIVE = 24  # most features of one token
GAPS = 3  # neighbours in a run, in the same 64 bytes, in the same 512
TIES = 2


@dataclass
class Token:
    start: int
    end: int
    text: bytes
    run: int = 0
    key: object = None
    exact: bytes = b""


@dataclass
class Tokens:
    """Candidate tokens of one document with their features, in order."""

    tokens: list[Token] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)


def plain_form(token: bytes) -> bytes:
    """Written-out "at" and "dot" put back."""
    return _DOT_FORM.sub(b".", _AT_FORM.sub(b"@", token))


def candidate_words(text: bytes) -> list[tuple[int, int]]:
    """Ends of the words that may be personal data; what is no such word has no label but none."""
    content = np.frombuffer(text, dtype=np.uint8)
    mark = _MARK[content]
    places = np.flatnonzero(mark)
    if b"[" in text or b"(" in text or b"{" in text:
        forms = [m.start() for m in _FORM.finditer(text)]
        if forms:
            places = np.union1d(places, np.array(forms))
    if not len(places):
        return []
    spaces = np.flatnonzero(_SPACE[content])
    word = np.unique(np.searchsorted(spaces, places))
    begin = np.concatenate([[0], spaces + 1])[word]
    stop = np.concatenate([spaces, [len(text)]])[word]
    total = np.concatenate([[0], np.cumsum(mark == 1)])
    many = total[stop] - total[begin]
    ends = zip(begin.tolist(), stop.tolist(), many.tolist())
    return [
        (a, b) for a, b, n in ends
        if n > 1 or b"@" in text[a:b] or (n and b"+" in text[a:b]) or _FORM.search(text, a, b)]


def _bucket(number: int) -> int:
    return sum(number >= limit for limit in _BUCKETS)


def _whole(token: bytes) -> bool:
    """Whether a token is a value by itself rather than a part of one: an address or ten digits and more."""
    return b"@" in token or len(digits_of(token)) >= 10


def tokens_of(text: bytes) -> Tokens:
    """Candidate tokens with features; a run is what may be the parts of one value, side by side."""
    found = Tokens()
    for start, end in candidate_words(text):
        found.tokens.append(Token(start, end, text[start:end]))
    runs: list[list[Token]] = []
    for token in found.tokens:
        last = runs[-1][-1] if runs else None
        if (last and token.start - last.end <= 2 and b"\n" not in text[last.end:token.start] and not _whole(token.text)
                and not _whole(last.text) and last.text[-1:] not in b".,;:" and token.text[:1] != b"+"):
            runs[-1].append(token)
        else:
            runs.append([token])
        token.run = len(runs) - 1
    for run in runs:
        digits = digits_of(b"".join(t.text for t in run if b"@" not in t.text))
        whole = text[run[0].start:run[-1].end]
        separated = bool(_SEPARATED.search(whole))
        run_luhn = 13 <= len(digits) <= 19 and luhn(digits)
        for token in run:
            plain = plain_form(token.text)
            own = digits_of(token.text)
            letters = sum(65 <= b <= 90 or 97 <= b <= 122 or b > 127 for b in token.text[:64])
            parts = plain.strip(b".,;:!?()[]").split(b".")
            four = len(parts) == 4 and all(p.isdigit() for p in parts) and small_parts(parts)
            if b"@" in plain:
                token.key, token.exact = ("address", plain.strip(b".,;:!?()[]<>\"'").lower()), token.text
            elif four:
                token.key, token.exact = ("parts", tuple(p.lstrip(b"0") for p in parts)), token.text
            elif len(digits) >= 7:
                token.key, token.exact = ("digits", digits[-7:]), digits[-10:]
            before = text[max(0, token.start - 24):token.start].split()[-1:]
            names = [
                "any", b"@" in token.text and "at", _AT_FORM.search(token.text) and "at form",
                _DOT_FORM.search(token.text) and "dot form", b"+" in token.text and "plus",
                (b"(" in token.text or b")" in token.text) and "bracket", b"-" in token.text and "dash",
                b"/" in token.text and "slash", (b"=" in token.text or b":" in token.text) and "equals or colon",
                b"_" in token.text and "underline",
                "no letters" if not letters else "few letters" if letters < 4 else "many letters",
                letters and len(token.text) >= 8 and not token.text.strip(b"0123456789abcdefABCDEF.,;") and "hex letters",
                b"@" in plain and _DOMAIN.match(plain, plain.rfind(b"@") + 1) and "domain", four and "four small parts",
                run_luhn and "run luhn", whole.startswith(b"+") and "run plus", separated and "run separated",
                len(run) == 1 and "run of one", len(token.text) > 40 and "long",
                f"digits {_bucket(len(own))}", f"run digits {_bucket(len(digits))}", f"dots {min(4, plain.count(b'.'))}",
                f"before {zlib.crc32(before[0].lower()) % _WORDS_BEFORE}" if before else None]
            found.features.append([_FEATURES[name] for name in names if name])
    return found


def graph_of(documents: list[Tokens]) -> Graph:
    """One graph of several documents; hubs only join tokens of one document, and only where two share a key."""
    features, left, right, gap, hub, tie = [], [], [], [], [], []
    hubs = base = 0
    for document in documents:
        groups: dict[object, list[int]] = {}
        for i, token in enumerate(document.tokens):
            chosen = document.features[i]
            features.append(chosen + [-1] * (ACTIVE - len(chosen)))
            if i:
                before = document.tokens[i - 1]
                apart = token.start - before.end
                if token.run == before.run or apart <= 512:
                    left.append(base + i - 1)
                    right.append(base + i)
                    gap.append(0 if token.run == before.run else 1 if apart <= 64 else 2)
            if token.key is not None:
                groups.setdefault(token.key, []).append(i)
        mine = [-1] * len(document.tokens)
        ties = [0] * len(document.tokens)
        for members in groups.values():
            if len({document.tokens[i].run for i in members}) > 1:  # at two places at least
                first = document.tokens[members[0]].exact
                for i in members:
                    mine[i], ties[i] = hubs, int(document.tokens[i].exact != first)
                hubs += 1
        hub += mine
        tie += ties
        base += len(document.tokens)
    numbers = np.array(features, dtype=np.int16).reshape(len(features), ACTIVE)
    as_array = lambda values: np.array(values, dtype=np.int64)
    return Graph(numbers, as_array(left), as_array(right), as_array(gap), as_array(hub), as_array(tie))


def labels_of(document: Tokens, spans: list[Span]) -> list[int]:
    """The kind of the first span that each token touches, 0 if it touches none."""
    labels, place = [], 0
    spans = sorted(spans)
    for token in document.tokens:
        while place < len(spans) and spans[place][2] <= token.start:
            place += 1
        touches = place < len(spans) and spans[place][0] < token.end
        labels.append(spans[place][1] + 1 if touches else 0)
    return labels


# --- learning -----------------------------------------------------------------------------------


def _variants(kind: int, value: bytes) -> list[bytes]:
    """Other ways to write a value, which the base patterns miss."""
    digits = digits_of(value)
    if kind == 0:
        local, _, domain = value.rpartition(b"@")
        return [local + b"[at]" + domain, local + b"(at)" + domain.replace(b".", b"(dot)"), local + b"[at]" + domain.replace(b".", b"[dot]")]
    if kind == 1:
        return [value.replace(b".", mark) for mark in (b"[.]", b"(.)", b"[dot]", b"(dot)")]
    if kind == 2:
        groups = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [mark.join(groups) for mark in (b".", b"/", b"_")]
    last, area, rest = digits[-4:], digits[-7:-4], digits[-10:-7]
    return [
        rest + b"-" + area + b"-" + last, b"(" + rest + b") " + area + b"-" + last, rest + b"." + area + b"." + last,
        rest + area + last, value.lstrip(b"+"), b"00" + digits[:-10] + b" " + rest + b" " + area + b" " + last]


def _spoiled(kind: int, value: bytes, turn: int) -> bytes | None:
    """The value made invalid, as an example of what is no personal data; now plain, now in another form."""
    digits = digits_of(value)
    if kind == 1:
        wrong = b".".join(str(int(part) % 300 + 300).encode() for part in value.split(b"."))
    elif kind == 2:
        wrong = digits[:-1] + str((digits[-1] - 48 + 1) % 10).encode()
    elif kind == 3:
        wrong = digits[-6:]
        return wrong[:3] + b"-" + wrong[3:] if turn % 2 else wrong
    else:
        return None
    return ([wrong] + _variants(kind, wrong))[turn % 4]


def _rewritten(text: bytes, spans: list[Span], turn: int) -> tuple[bytes, list[Span], list[Span]]:
    """A text with its values rewritten, and at its end a spoiled form of each and every second plain value; the
    spans of values and of spoiled ones."""
    out, at, marked, wrong = [], 0, [], []
    length = 0

    def add(piece: bytes) -> None:
        nonlocal length
        out.append(piece)
        length += len(piece)

    for number, (start, kind, end) in enumerate(spans):
        if start < at:
            continue
        add(text[at:start])
        listed = _variants(kind, text[start:end])
        new = listed[(turn + number) % len(listed)]
        marked.append((length, kind, length + len(new)))
        add(new)
        at = end
    add(text[at:])
    for number, (start, kind, end) in enumerate(spans):
        # On lines of their own, after whatever word comes last, so that no word gives them away.
        spoiled = _spoiled(kind, text[start:end], turn + number)
        if spoiled:
            add(b"\n")
            wrong.append((length, kind, length + len(spoiled)))
            add(spoiled)
        if (turn + number) % 2:
            add(b"\n")
            marked.append((length, kind, length + end - start))
            add(text[start:end])
        words = text[:start].split()[-3 - number % 5:][:1]
        add(b"\n" + (words[0] if words else b""))
    return b"".join(out), marked, wrong


def learn(texts: list[bytes], steps: int = 400) -> Model:
    """A model from texts whose base spans are the labels, and their rewritten forms.

    Tokens in matches that failed their rule are no examples: a card beside another number fails as well.
    """
    documents, labels, counted = [], [], []
    for turn, text in enumerate(texts):
        spans = base_spans(text)
        for given, marked, wrong in [(text, spans, [])] + ([_rewritten(text, spans, turn)] if spans else []):
            tokens = tokens_of(given)
            if tokens.tokens:
                documents.append(tokens)
                own = labels_of(tokens, marked)
                failed, spoiled = labels_of(tokens, base_matches(given)[1]), labels_of(tokens, wrong)
                labels += own
                counted += [bool(label or known or not open_) for label, known, open_ in zip(own, spoiled, failed)]
    return fit(
        graph_of(documents), np.array(labels, dtype=np.int64), FEATURES, LABELS, GAPS, TIES, steps,
        counted=np.array(counted, dtype=bool))


# --- spans of the model -------------------------------------------------------------------------

_EDGE = b".,;:!?\"'<>"
_PHONE_FORM = re.compile(rb"\+?[0-9(][0-9 ().+/-]*[0-9]")
_CARD_FORM = re.compile(rb"[0-9]+(?:[ ._/-]{1,2}[0-9]+)*")


def well_formed(kind: int, value: bytes, known: set[bytes]) -> bool:
    """Whether a stretch is one value of its kind; ``known`` has the last ten digits of the document's base numbers."""
    digits = digits_of(value)
    if kind == 0:
        plain = plain_form(value)
        ends = list(emails(plain))
        return ends == [(0, len(plain))]
    if kind == 1:
        parts = plain_form(value).split(b".")
        return len(parts) == 4 and all(p.isdigit() for p in parts) and small_parts(parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and bool(_CARD_FORM.fullmatch(value))
    if not 10 <= len(digits) <= 15 or not _PHONE_FORM.fullmatch(value):
        return False
    return digits[-10:] in known or bool(_SEPARATED.search(value))


def added_spans(text: bytes, document: Tokens, best: np.ndarray, sure: np.ndarray, base: list[Span]) -> list[Span]:
    """Well-formed values among runs of certain tokens that touch no base span."""
    known = {digits_of(text[a:b])[-10:] for a, kind, b in base if kind == 3}
    free = [label == 0 for label in labels_of(document, base)]
    found: list[Span] = []
    tokens = document.tokens
    i = 0
    while i < len(tokens):
        label = int(best[i])
        if not label or not sure[i] or not free[i]:
            i += 1
            continue
        j = i
        while j + 1 < len(tokens) and tokens[j + 1].run == tokens[i].run and best[j + 1] == label and sure[j + 1] and free[j + 1] and j - i < 8:
            j += 1
        # The longest stretch from here that is one value.
        for last in range(j, i - 1, -1):
            start, end = tokens[i].start, tokens[last].end
            while start < end and text[start] in _EDGE:
                start += 1
            while end > start and text[end - 1] in _EDGE:
                end -= 1
            if well_formed(label - 1, text[start:end], known):
                found.append((start, label - 1, end))
                i = last
                break
        i += 1
    return found


def scan(texts: list[bytes], model: Model, certain: float = CERTAIN) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of every text, in bytes."""
    base = [base_spans(text) for text in texts]
    documents = [tokens_of(text) for text in texts]
    some = [i for i, document in enumerate(documents) if document.tokens]
    every = [list(spans) for spans in base]
    if some:
        chance = model.marginals(graph_of([documents[i] for i in some]))
        best, top = chance.argmax(axis=1), chance.max(axis=1)
        begin = 0
        for i in some:
            end = begin + len(documents[i].tokens)
            every[i] = sorted(base[i] + added_spans(texts[i], documents[i], best[begin:end], top[begin:end] >= certain, base[i]))
            begin = end
    return list(zip(base, every))


def learned_model(docs: DataFrame, text: str = "text", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """The model of a sample of texts with a digit or an ``@``, drawn by the hash of their rows.

    The lowest hashes are found first and their texts fetched afterwards, once per hash, so that tasks send
    the driver no more than hashes.
    """
    atomic = [f.name for f in docs.schema if isinstance(f.dataType, AtomicType)]
    value = F.col(text)
    rows = docs.filter(value.rlike("[0-9@]") & (F.length(value) <= sample_chars)).select(
        value.alias("text"), F.xxhash64(*[F.col(f"`{name}`") for name in atomic]).alias("drawn"))
    lowest = [row["drawn"] for row in rows.select("drawn").orderBy("drawn").limit(sample).collect()]
    if not lowest:
        return learn([])
    chosen = rows.filter(F.col("drawn") <= lowest[-1]).groupBy("drawn").agg(F.min("text").alias("text")).collect()
    return learn(sorted({row["text"].encode() for row in chosen}))


def find_personal_data(
    docs: DataFrame, text: str = "text", model: Model | None = None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: kind, start and end, by start, then in the order of kinds."""
    model = model or learned_model(docs, text)

    def make():
        def step(batch: pa.RecordBatch):
            texts = [t or b"" for t in texts_of(batch.column(0))]
            base, every = [], []
            for content, (first, second) in zip(texts, scan(texts, model)):
                points = None
                if second:
                    points = np.concatenate([[0], np.cumsum((np.frombuffer(content, dtype=np.uint8) & 0xC0) != 0x80)])
                for out, found in ((base, first), (every, second)):
                    out.append([{"kind": KINDS[k], "start": int(points[s]), "end": int(points[e])} for s, k, e in found])
            return base, every

        return step

    return add_columns(docs, [text], FIELDS, make, block_bytes)
