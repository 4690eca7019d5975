from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from plaudit.llm import collocations, phrase_trie

SCHEMA = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.StringType())])


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain(rows, least=10, longest=3, keep=2000):
    """All phrases counted one by one."""
    counts, n = collections.Counter(), collections.Counter()
    for text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    found = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    out = collections.defaultdict(list)
    for (lang, w), a in found.items():
        longer = [f for (other, v), f in found.items() if other == lang and len(v) > len(w)
                  and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * f >= 50 * a for f in longer):
            continue
        score, _, l, r = min(
            (1000000 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]])
            for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, listed in out.items() for rank, (score, a, phrase, l, r) in enumerate(sorted(listed)[:keep], 1))


def mined(spark, rows, parts=3, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = collocations.mine_collocations(docs, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


def corpus(seed, documents=160):
    draw = random.Random(seed)
    vocabulary = ["the", "New", "york", "é", "日本", "a\x00b", "x" * 70, "of", "stock", "Exchange", "co-op", "q z"]
    gaps = [" ", "  ", "\t", " \t ", ". ", ", ", "\n", "? ", " ; ", "\r\n"]
    rows = []
    for _ in range(documents):
        text = "".join(draw.choice(vocabulary) + draw.choices(gaps, [12, 2, 2, 1, 1, 1, 1, 1, 1, 1])[0] for _ in range(draw.randrange(40)))
        rows.append((text, draw.choice(["en", "en", "de", None, "und", ""]), "s"))
    return rows + [(None, "en", None), ("", None, None), (" \t\n", "xx", None), ("...", "en", None)]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases_equal_brute_force(spark, longest):
    rows = corpus(1)
    assert mined(spark, rows, longest=longest) == plain(rows, longest=longest)


def test_many_blocks_of_buckets_and_tries_change_nothing(spark):
    rows = corpus(2, 120)
    assert mined(spark, rows, bucket_bytes=400, trie_bytes=900) == plain(rows)


def test_copies_short_lists_and_ties(spark):
    rows = corpus(3, 40) + [("ties here. here ties", "en", None)] * 12 + [("b c a b c. a b", "zz", None)] * 30
    assert mined(spark, rows, keep=4) == plain(rows, keep=4)


def test_empty_and_rare(spark):
    assert mined(spark, []) == []
    assert mined(spark, [("one two three", "en", None), (None, None, None)]) == []


def test_long_text_is_cut_only_between_pieces(spark, monkeypatch):
    draw = random.Random(4)
    text = "".join(draw.choice(["alpha", "beta", "gamma"]) + draw.choice([" ", " ", " ", ", "]) for _ in range(4000))
    unbroken = " ".join(draw.choice(["alpha", "beta"]) for _ in range(3000))
    rows = [(text, "en", None), (unbroken, "en", None)]
    assert list(collocations._slices(b"ab.cd;ef", 3)) == [b"ab.cd", b"ef"]
    assert list(collocations._slices(b"abcdef", 3)) == [b"abcdef"]
    sliced = [part for value, _, _ in rows for part in collocations._slices(value.encode(), 500)]
    assert len(sliced) > 20
    assert plain([(part.decode(), "en", None) for part in sliced]) == plain(rows) == mined(spark, rows)


def test_words_of_texts():
    words = phrase_trie.words_in(phrase_trie.plain_words([b"", b"A  b\t.c", b"", b"d\r\ne f"]))
    raw = words.raw.tobytes()
    assert [raw[a:b] for a, b in zip(words.start, words.end)] == [b"a", b"b", b"c", b"d", b"e", b"f"]
    assert words.last.tolist() == [False, True, True, True, False, True]


def test_trie_counts_every_phrase():
    draw = random.Random(6)
    letters = [bytes(draw.randrange(1, 256) for _ in range(draw.randrange(1, 4))) for _ in range(300)]
    clean = [word for word in letters if not set(word) & set(b" \t.,;:!?\n\x0b\x0c\r") and word == word.lower()]
    keys = sorted({(lang, b" ".join(draw.choices(clean, k=draw.randrange(1, 4)))) for lang in (b"a", b"b", b"") for _ in range(900)})
    trie = phrase_trie.build(pa.array([lang for lang, _ in keys], pa.binary()), pa.array([phrase for _, phrase in keys], pa.binary()))
    assert np.unique(trie.check[trie.check >= 0]).size < (trie.check >= 0).sum()
    text = b" ".join(draw.choices(clean, k=5000))
    words = phrase_trie.words_in(phrase_trie.plain_words([text]))
    counts = np.zeros(trie.phrases, dtype=np.int64)
    trie.count(words, b"b", counts)
    trie.count(words, b"no such language", counts)
    listed = text.split(b" ")
    seen = collections.Counter(b" ".join(listed[i:i + k]) for k in (1, 2, 3) for i in range(len(listed) - k + 1))
    assert counts.tolist() == [seen[phrase] if lang == b"b" else 0 for lang, phrase in keys]


def test_tries_share_the_text_out(spark, monkeypatch):
    draw = random.Random(7)
    rows = [(" ".join(draw.choices(["a", "b", "cc", "dd", "eee", "fff"], k=30)), "en", "s") for _ in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    counted, read = collocations._shard_counts, []

    def counting(runs, *others):
        read.append(sum(len(row[0]) for row in runs.select("words").collect()))
        return counted(runs, *others)

    monkeypatch.setattr(collocations, "_shard_counts", counting)
    found = []
    for trie_bytes in (1 << 20, 1000):
        counts, _ = collocations.phrase_counts(docs, trie_bytes=trie_bytes)
        found.append((sorted(map(tuple, counts.collect())), list(read)))
        read.clear()
    (one, at_once), (many, in_turn) = found
    assert one == many
    assert len(at_once) == 1 < len(in_turn)
    assert sum(in_turn) == sum(at_once)


def test_distinct_runs_count_every_phrase_once():
    draw = random.Random(8)
    text = b"".join(draw.choice([b"a", b"b", b"cc", b"dd"]) + draw.choice([b" ", b" ", b"\n"]) for _ in range(3000)) + b"a\n"
    words = phrase_trie.words_in(np.frombuffer(text, dtype=np.uint8))
    hashes, salt = collocations.PhraseHashes(), np.uint64(5)
    every = np.concatenate([value for value, _, _ in hashes.of(words, salt, 3)])
    sieve = collocations.Sieve(len(every))
    sieve.add(every)
    first, last, _, counts = collocations._distinct_runs(words, salt, 3, hashes, sieve)
    runs = [text[a:b] for a, b in zip(words.start[first], words.end[last])]
    assert len(set(runs)) == len(runs)
    listed = [piece.split(b" ") for piece in text.split(b"\n") if piece]
    seen = collections.Counter(b" ".join(p[i:i + k]) for p in listed for k in (1, 2, 3) for i in range(len(p) - k + 1))
    keys = sorted(seen)
    trie = phrase_trie.build(pa.array([b"x"] * len(keys), pa.binary()), pa.array(keys, pa.binary()))
    found = np.zeros(len(keys), dtype=np.int64)
    raw = np.frombuffer(b"".join(run + b"\n" for run in runs), dtype=np.uint8)
    trie.count(phrase_trie.words_in(raw), b"x", found, counts)
    assert found.tolist() == [seen[key] for key in keys]


def test_candidates_come_from_one_pass_however_many_blocks_of_buckets(spark, monkeypatch):
    rows = corpus(9, 120)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found, passes = collocations._candidates, []

    def finding(*given):
        passes.append(1)
        return found(*given)

    monkeypatch.setattr(collocations, "_candidates", finding)
    assert sorted(map(tuple, collocations.mine_collocations(docs, bucket_bytes=200).collect())) == plain(rows)
    assert len(passes) == 1


def test_rows_for_a_trie_do_not_grow_with_the_blocks_of_text(spark, monkeypatch):
    draw = random.Random(10)
    rows = [(" ".join(draw.choices(["a", "b", "cc", "dd", "eee", "fff"], k=300)), "en", "s") for _ in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(1)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 4000)
    counted, dealt = collocations._shard_counts, []

    def counting(runs, *others):
        dealt.append(runs.count())
        return counted(runs, *others)

    monkeypatch.setattr(collocations, "_shard_counts", counting)
    found = sorted(map(tuple, collocations.mine_collocations(docs, trie_bytes=1000).collect()))
    assert found == plain(rows)
    assert len(dealt) > 1 and max(dealt) <= spark.sparkContext.defaultParallelism


def test_tries_are_counted_in_waves(spark, monkeypatch):
    draw = random.Random(11)
    rows = [(" ".join(draw.choices(["a", "b", "cc", "dd", "eee", "fff"], k=30)), "en", "s") for _ in range(200)]
    monkeypatch.setattr(collocations, "WAVE", 2)
    waves = []
    ran = collocations.together

    def running(session, actions, **options):
        waves.append(len(actions))
        return ran(session, actions, **options)

    monkeypatch.setattr(collocations, "together", running)
    found = mined(spark, rows, trie_bytes=400)
    assert found == plain(rows) != []
    assert waves[0] > 1


def test_sent_numbers_are_told_once():
    sent = collocations.Sent()
    given = np.array([0, 1, 7, 7, 1 << collocations.SENT_BITS, 0], dtype=np.uint64)
    assert sorted(given[sent.new(given)].tolist()) == [0, 1, 7, 1 << collocations.SENT_BITS]
    assert given[sent.new(given[:4])].tolist() in ([], [0])  # zero and the last number share a place
    assert sent.new(np.empty(0, dtype=np.uint64)).tolist() == []


def test_small_shares_and_high_least(spark, monkeypatch):
    rows = corpus(12, 60) + [("one two one two three. two one", "en", None)] * 300
    assert mined(spark, rows, keep=3, least=290) == plain(rows, keep=3, least=290)
