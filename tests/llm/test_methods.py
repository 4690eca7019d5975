"""The methods themselves, without Spark, against brute force."""

from __future__ import annotations

import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from plaudit.llm import context_tree, jaccard_join, language_model, license_scan, secrets, substring_dedup, toxicity
from plaudit.llm.automaton import Nfa, determinise
from plaudit.llm.common import merged_runs, plain_words
from plaudit.llm.decontaminate import Phrases
from plaudit.llm.elias_fano import EliasFano
from plaudit.llm.fm_index import FmIndex, suffix_order
from plaudit.llm.substring_dedup import WordHashes
from plaudit.llm.token_files import WordEncoder


def test_merged_runs():
    random.seed(3)
    for _ in range(200):
        starts = np.array([random.randint(0, 30) for _ in range(random.randint(0, 8))], dtype=np.int64)
        sizes = np.array([random.randint(1, 6) for _ in starts], dtype=np.int64)
        wanted = {p for s, n in zip(starts, sizes) for p in range(s, s + n)}
        runs = merged_runs(starts, sizes)
        assert {p for a, b in runs for p in range(a, b)} == wanted
        assert all(b < c for (_, b), (c, _) in zip(runs, runs[1:]))


def test_fm_index_finds_every_occurrence():
    random.seed(5)
    for _ in range(60):
        symbols = np.array([random.randint(0, 4) for _ in range(random.randint(1, 80))] + [0], dtype=np.int64)
        order = suffix_order(symbols, 3)
        assert sorted(order.tolist()) == list(range(len(symbols)))
        index = FmIndex(symbols, 5)
        phrase = np.array([[random.randint(1, 4) for _ in range(3)]])
        for length in (1, 2, 3):
            low, high = index.search(phrase, np.array([length]))
            found = sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist())
            wanted = [
                i for i in range(len(symbols) - length) if symbols[i:i + length].tolist() == phrase[0, :length].tolist()]
            assert found == wanted


def test_phrases_match_brute_force():
    random.seed(1)
    words = [f"w{i}" for i in range(6)]
    for _ in range(80):
        items = [(str(i), " ".join(random.choices(words, k=random.randint(0, 7)))) for i in range(5)]
        docs = [" ".join(random.choices([*words, "x"], k=random.randint(0, 40))) for _ in range(6)]
        docs += [docs[0], "", None]
        counts, spans, ids = Phrases(items, 3).spans([None if d is None else d.encode() for d in docs])
        for doc, count, found, listed in zip(docs, counts, spans, ids):
            have, hit, owners = (doc or "").split(), set(), set()
            for item, text in items:
                given = text.split()
                size = min(3, len(given))
                for a in range(max(1, len(given) - 2) if given else 0):
                    for b in range(len(have) - size + 1):
                        if have[b:b + size] == given[a:a + size]:
                            hit.update(range(b, b + size))
                            owners.add(item)
            assert (count, listed) == (len(have), sorted(owners))
            assert {p for a, b in found for p in range(a, b)} == hit


def test_automaton_agrees_with_re():
    random.seed(7)
    for pattern in (r"a(b|c)*d?", r"[a-c]{2}x+", r"(?i:ab)c?[^d]", r"(ab|b)+c"):
        nfa = Nfa()
        start, end = nfa.add(pattern)
        dfa = determinise(nfa, [start], [end], anywhere=False)
        for _ in range(300):
            text = "".join(random.choices("abcdxAB", k=random.randint(0, 6))).encode()
            state = 0
            for byte in text:
                state = dfa.table[state, dfa.classes[byte]]
            assert bool(dfa.accepts[state]) == bool(re.fullmatch(pattern.encode(), text)), (pattern, text)


BASE = (
    (re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 1, 8),
    (re.compile(rb"AKIA[A-Z0-9]+"), 0, 16), (re.compile(rb"[0-9a-f]+"), 0, 32))


def test_secrets_match_leftmost_expressions():
    random.seed(2)
    scanner = secrets.Scanner(secrets.RULES)
    pieces = ["token", "my_token", "secret", "PASSWORD", "api_key", "=", ":", "  ", '"', "abc", "abcdefgh12", "AKIA",
              "AKIAABCDEF", "0123456789abcdef", "0123456789abcdef", "Z", "é", "\n"]
    texts = ["".join(random.choices(pieces, k=random.randint(0, 40))).encode() for _ in range(3000)] + [b""]
    ends: dict = {}
    for (text, rule), places in scanner.ends(texts).items():
        ends.setdefault(text, {})[rule] = places
    for number, text in enumerate(texts):
        wanted = sorted(
            (m.start(), kind, m.end()) for kind, (rule, group, least) in enumerate(BASE) for m in rule.finditer(text)
            if len(m.group(group)) >= least)
        base, every = scanner.spans(text, ends.get(number, {}))
        assert base == wanted, text
        assert set(base) <= set(every)


def every_secret(text):
    """Base matches by expression, and of the others, by start, the first of enough length of every end."""
    base, every = [], []
    for number, rule in enumerate(secrets.RULES):
        exact = re.compile(rule.pattern.encode())
        group = 1 if rule.base and exact.groups else 0
        taken, ends = -1, set()
        for start in range(len(text)):
            match = exact.match(text, start)
            if not match:
                continue
            first = start >= taken
            taken = match.end() if first else taken
            if len(match.group(group)) >= rule.least and (first or match.end() not in ends):
                ends.add(match.end())
                every.append((start, number, match.end()))
                if first and rule.base:
                    base.append((start, number, match.end()))
    return sorted(base), sorted(every)


@pytest.mark.parametrize("long", [0, 1 << 16])
def test_all_secrets_by_trying_every_start(monkeypatch, long):
    """Base and added spans, with texts scanned in step and one by one."""
    monkeypatch.setattr(secrets, "LONG", long)
    generator = random.Random(5)
    pieces = ["token", "secret", "=", ": ", '"', "abc", "abcdefgh12", "AKIA", "AKIAABCDEF", "0123456789abcdef", "Z", "é", " ",
              "ghp_", "a1B2" * 10, "xoxb-", "12345-abcde", "-----BEGIN ", "RSA ", "PRIVATE KEY-----"]
    texts = ["".join(generator.choices(pieces, k=generator.randint(0, 25))).encode() for _ in range(600)]
    scanner = secrets.Scanner(secrets.RULES)
    ends: dict = {}
    for (text, rule), places in scanner.ends(texts).items():
        ends.setdefault(text, {})[rule] = places
    for number, text in enumerate(texts):
        assert scanner.spans(text, ends.get(number, {})) == every_secret(text), text


@pytest.mark.parametrize("run", [b"0123456789abcdef", b"token=", b"AKIA", b"xoxb-", b"secret = "])
def test_secrets_in_long_runs_take_linear_time(run):
    scanner = secrets.Scanner(secrets.RULES)

    def seconds(size):
        text = run * (size // len(run)) + b"abcdefgh1"
        begin = time.process_time()
        scanner.spans(text, scanner.ends_of_one(text))
        return time.process_time() - begin

    assert seconds(4 << 20) < 60
    assert seconds(2 << 20) < 6 * seconds(1 << 20) + 1


def test_elias_fano_round_trip():
    generator = np.random.default_rng(11)
    for bound in (1, 5, 1000, 10**9):
        for count in (0, 1, 64, 700):
            values = np.sort(generator.integers(0, bound, count))
            content = EliasFano.encode(values)
            assert (EliasFano(content).select(np.arange(count)) == values).all()
            if count:
                assert len(content) * 8 <= count * (3 + math.log2(max(2, bound / count))) + 600


def test_words_encode_as_the_tokenizer_does():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        encoder = WordEncoder(file.read(), 1)
    texts = [
        None, "", "Plain words, plain words.", "<|startoftext|> A b<|ENDOFTEXT|>", "Don't stop... x’s ‘y’ l’é. É. ÀÉ*",
        "a--b. (x) \"Quoted\" -- .a. 12.5, 3. 3a. a3, ½ ﬁ. Ǆ, ΑΣ. İ", "é ́x ñ.", "word " * 3000, "###"]
    for _ in range(2):  # the second time all words are known
        ids, ends = encoder.encode([None if t is None else t.encode() for t in texts])
        for text, start, end in zip(texts, [0, *ends[:-1]], ends):
            assert ids[start:end].tolist() == whole.encode(text or "", add_special_tokens=False).ids + [1], text


def test_window_hashes_are_equal_for_equal_windows_only():
    words = np.random.default_rng(1).integers(0, 3, 400)
    memory = WordHashes()
    hashed = np.array([memory[str(w).encode()] for w in words], dtype=np.uint64)
    found = substring_dedup.window_hashes(hashed, 5)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    assert len(found) == len(windows)
    assert len(set(found.tolist())) == len(set(windows)) == len(set(zip(found.tolist(), windows)))


def test_labels_of_similar_texts_meet():
    random.seed(4)
    depth = jaccard_join.prefix_depth(0.8, 0.999)
    texts, met, pairs = [], 0, 300
    for _ in range(pairs):
        one = [str(random.random()).encode() for _ in range(200)]
        other = list(one)
        for place in random.sample(range(200), 3):
            other[place] = b"x%d" % place
        texts += [one, other]
    found = jaccard_join.labels(*jaccard_join.shingles(texts, 5, WordHashes())) >> (
        jaccard_join.BITS * (jaccard_join.DEPTH - depth))
    for i in range(pairs):
        met += bool((found[2 * i] == found[2 * i + 1]).any())
    assert met == pairs
    assert len({tuple(row) for row in found.tolist()}) > pairs


def test_context_tree_is_a_distribution_and_learns():
    texts = [b"the cat sat", b"the dog sat", b"a cat", b"", b"the the the"] * 5
    keys = np.sort(context_tree.keys_of(*context_tree.stream_of(texts)))
    names, counts = np.unique(keys, return_counts=True)
    levels = []
    for depth in range(context_tree.DEPTH + 1):
        name, zeros, ones = context_tree.decisions(names, counts, depth)
        kept = zeros + ones >= 2
        levels.append((name[kept], zeros[kept], ones[kept]))
    tree = context_tree.build(levels)
    for context in names[:20] >> 8:
        every = (context << 8) | np.arange(256)
        assert np.exp(tree.log_probability(every)).sum() == pytest.approx(1.0)
    content, starts, lengths = context_tree.stream_of([b"the cat", b"qzx kwv"])
    values = tree.log_probability(context_tree.keys_of(content, starts, lengths))
    assert values[:8].sum() > values[8:].sum() + 10


def brute_weighted(levels, depth, name):
    """The recursive definition: half the own estimate, half the product over children and the rest."""
    table = {int(n): (int(a), int(b)) for n, a, b in zip(*levels[depth])}
    zeros, ones = table[name]

    def estimate(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    if depth == context_tree.DEPTH:
        return estimate(zeros, ones)
    total = 0.0
    for child, a, b in zip(*levels[depth + 1]):
        if ((int(child) >> 16) << 8) | (int(child) & 255) == name:
            total += brute_weighted(levels, depth + 1, int(child))
            zeros, ones = zeros - int(a), ones - int(b)
    return float(np.logaddexp(estimate(*table[name]), total + estimate(zeros, ones)) - math.log(2))


def test_context_tree_prediction_is_a_quotient_of_weighted_probabilities():
    texts = [b"abab", b"abba", b"aab"]
    names, counts = np.unique(context_tree.keys_of(*context_tree.stream_of(texts)), return_counts=True)
    levels = [context_tree.decisions(names, counts, d) for d in range(context_tree.DEPTH + 1)]
    tree = context_tree.build(levels)
    # One more 1 at the first decision after some seen context changes its path only.
    key = int(names[3])
    more = []
    for depth, (name, zeros, ones) in enumerate(levels):
        mine = ((key >> (8 * (context_tree.DEPTH + 1 - depth))) << 8) | 1
        more.append((name, zeros, ones + (name == mine)))
    ratio = math.exp(brute_weighted(more, 0, 1) - brute_weighted(levels, 0, 1))
    deepest = tree.ones[context_tree.DEPTH][
        np.searchsorted(tree.names[context_tree.DEPTH], ((key >> 8) << 8) | 1)]
    assert deepest == pytest.approx(ratio, rel=1e-9)


def test_alignment():
    assert license_scan.increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])
    assert license_scan.align([1, 2, 3, 4], [9, 1, 9, 3, 4]) == [(0, 1), (2, 3), (3, 4)]
    random.seed(6)
    for _ in range(200):
        a, b = random.choices(range(5), k=7), random.choices(range(5), k=9)
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))


def mutated_notices(seed, count):
    """Texts of notices with a word or number changed, dropped or added, between other words."""
    generator = random.Random(seed)
    extra = ["the", "license", "under", "x", "lesser", "2", "3", "nc", "sa", "mit", "version"]
    for _ in range(count):
        text = []
        for _ in range(generator.randint(1, 2)):
            given = plain_words(generator.choice(license_scan.TEMPLATES).text.encode())
            for _ in range(generator.randint(0, 2)):
                at = generator.randrange(len(given))
                given[at:at + generator.randint(0, 1)] = [w.encode() for w in generator.sample(extra, generator.randint(0, 1))]
            text += [w.encode() for w in generator.choices(extra, k=generator.randint(0, 4))] + given
        yield b" ".join(text)


def every_window(text):
    """All windows of all templates, aligned one by one; of runs of matches the best, of overlaps the better."""
    words, found = text.split(), []
    for number, template in enumerate(license_scan.TEMPLATES):
        mine = plain_words(template.text.encode())
        needs, bars = (plain_words(t.encode()) for t in (template.needs, template.bars))
        size, best, done = len(mine) + len(mine) // 4 + 2, None, 0
        for start in range(len(words)):
            if best and start >= best[2]:
                found.append(best)
                best, done = None, best[2]
            window = words[start:start + size]
            if start < done or window[0] not in mine:
                continue
            pairs = license_scan.align(mine, window)
            inner = {j for _, j in pairs}
            if len(pairs) < 0.8 * len(mine) or not all(any(window[j] == n for j in inner) for n in needs):
                continue
            low, high = min(inner), max(inner)
            if any(window[j] in bars for j in range(low, high) if j not in inner):
                continue
            if best is None or len(pairs) > -best[0]:
                best = (-len(pairs), start + low, start + high + 1, -len(pairs) / len(mine), template.license, number)
        if best:
            found.append(best)
    kept = []
    for many, start, end, share, name, number in sorted(found, key=lambda f: (f[0], f[3], f[1], f[4], f[5])):
        if all(end <= other[1] or start >= other[2] for other in kept):
            kept.append((name, start, end, -share))
    return sorted(kept, key=lambda m: m[1])


def test_licenses_agree_with_a_scan_over_all_windows():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    texts = list(mutated_notices(8, 60))
    counts, found = scanner.scan(texts)
    assert counts == [len(t.split()) for t in texts]
    assert found == [every_window(t) for t in texts]
    assert sum(map(len, found)) > 30


@pytest.mark.parametrize("text, names", [
    ("licensed under the GNU General Public License, version 2", ["GPL-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any "
     "later version.", ["GPL-2.0"]),
    ("licensed under the GNU Lesser General Public License, version 2.1", ["LGPL-2.1"]),
    ("licensed under the GNU Lesser General Public License, version 3", ["LGPL-3.0"]),
    ("licensed under the GNU Library General Public License, version 2", []),
    ("licensed under the GNU Affero General Public License, version 3", ["AGPL-3.0"]),
    ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]), ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]), ("Licensed under CC BY-NC-SA 4.0", ["CC-BY-NC-SA-4.0"]),
    ("Licensed under CC BY-NC 3.0.", []),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"]),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
    ("Licensed under the Apache License, Version 1.1.", []), ("Licensed under the Apache License, Version 2.0", ["Apache-2.0"]),
    ("Released under the Apache License", []), ("Released under the BSD License", []), ("Released under the MIT License", ["MIT"]),
    ("Licensed under the BSD 2-Clause License", ["BSD-2-Clause"]), ("Licensed under the BSD 3-Clause License", ["BSD-3-Clause"]),
])
def test_license_names(text, names):
    _, found = license_scan.Scanner(license_scan.TEMPLATES, 0.8).scan([f"Some words. {text} And more.".encode()])
    assert [m[0] for m in found[0]] == names


def test_whole_license_texts():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    whole = [t for t in license_scan.TEMPLATES if len(t.text) > 500]
    _, found = scanner.scan([f"Copyright (c) 2020 Someone. {t.text} Contents.".encode() for t in whole])
    assert [[m[0] for m in f] for f in found] == [[t.license] for t in whole]


def test_licenses_in_long_runs_of_one_word():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    counts, found = scanner.scan([b"license " * 300_000, b"the software " * 100_000])
    assert (counts, found) == ([300_000, 200_000], [[], []])


def test_license_examples():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    counts, found = scanner.scan([
        b"Licensed under the Apache License, Version 2.0. Licensed under Apache License, Version 2.0! x", None, b"",
        b"so. Released under the MIT License. " * 2, b"plain text under the table"])
    assert [[m[:3] for m in f] for f in found] == [
        [("Apache-2.0", 0, 8), ("Apache-2.0", 8, 15)], [], [], [("MIT", 1, 6), ("MIT", 7, 12)], []]
    assert counts == [16, 0, 0, 12, 5]


def test_toxicity_model_tells_words_apart():
    random.seed(9)
    words = ["".join(random.choices("abcdefghij", k=random.randint(2, 8))) for _ in range(400)]

    def text(bad):
        chosen = random.choices(words, k=80)
        if bad:
            for place in random.sample(range(80), 5):
                chosen[place] = random.choice(["zorkwump", "vexquaff"])
        return " ".join(chosen).encode()

    model = toxicity.train([text(True) for _ in range(60)], [text(False) for _ in range(200)])
    distance = toxicity.Distance(model)

    def score(content):
        return toxicity._curve(np.array([distance.features(toxicity.words_of(content))]), np.array(model.weights))[0]

    assert sum(score(text(True)) >= 0.7 for _ in range(50)) >= 48
    assert sum(score(text(False)) >= 0.7 for _ in range(50)) <= 2
    assert 0 <= score(None) < 0.7 and score(b"") == score(None)
    assert toxicity.train([], [b"x"]) is None


def test_token_ids_look_up_a_word_once_a_block():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = WordEncoder(file.read(), 1)
    looked_up = []

    class Known(dict):
        def __getitem__(self, word):
            looked_up.append(word)
            return super().__getitem__(word)

    encoder.known = Known()
    words = ["plain", "(Marked),", "É\u0301t\u00e9", "a\u00a0b", "don't", "12", "...", "日本", "a\x1cb"]
    texts = ["  ".join(words) + "\n", None, "", " \t", "\x0b".join(words) * 40, "<|endoftext|> " + words[0]] * 30
    ids, ends = encoder.encode([None if text is None else text.encode() for text in texts])
    expected = [[*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1] for text in texts]
    assert [part.tolist() for part in np.split(ids, ends[:-1])] == expected
    assert len(looked_up) < 100


def test_counts_of_a_chunk_travel_without_differences():
    draw = random.Random(9)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randrange(2, 7))) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(40), pa.int64()), pa.array([i % 7 == 2 for i in range(40)]),
        pa.array([" ".join(draw.choices(vocabulary, k=500)) for _ in range(40)])], names=["doc_id", "held_out", "text"])
    rows = [row for out in language_model._send(4, 4, 1 << 20)(iter([batch])) for row in out.to_pylist()]
    rows = [row for row in rows if row["kind"] == language_model.GRAMS]
    counts = np.concatenate([language_model._unpacked_counts(row["counts"]) for row in rows])
    keys = np.concatenate([language_model._unpacked(row["names"], np.int64) for row in rows])
    chunk = language_model.Chunk(batch, WordHashes(), 4)
    names, _, trained, place, lengths = chunk.grams(4)
    assert (names == keys).all() and (trained == counts).all()
    assert (names[place] == context_tree.keys_of(*context_tree.stream_of(chunk.texts))).all() and lengths.sum() == len(place)
    assert sum(len(row["counts"]) for row in rows) < 0.7 * sum(
        len(language_model._packed(language_model._unpacked_counts(row["counts"]))) for row in rows)
