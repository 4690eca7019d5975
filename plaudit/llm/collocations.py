"""Phrase collocations per language, counted with broadcast double-array tries.

Texts are lower-cased (A-Z) and cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at
blanks and tabs; this plain form is stored once. A phrase is two to ``longest`` words in a row inside a piece.

1. Candidates. Every phrase falls into one of 2^48 hash buckets; tasks count buckets, and a shuffle by
   ranges of buckets adds up what is sent as packed, sorted differences. A bucket's count is at least the
   count of each of its phrases, so phrases of buckets below ``least`` can be left out safely; the phrases
   of the others, and with them every part of theirs that is a phrase, are the candidates. One pass over the
   texts finds them, however many buckets there are: tasks hold a bitmap of the buckets' highest bits, and what
   it lets through meets its buckets in a shuffle by the same ranges. The driver reads the buckets for the bitmap
   in blocks of at most ``BUCKET_BYTES``.
2. Counts. Candidates and their words become double-array tries of about ``TRIE_BYTES`` of keys each, built
   in tasks, broadcast for one job of ``WAVE`` tries. A phrase is dealt to a trie by its first two words, a word
   by itself. One pass over the texts deals what can be counted in the same way: the distinct words of a block of
   text, and from each word start the longest run whose buckets can be frequent, with their numbers. A trie meets
   only what is dealt to it, so the work does not grow with the number of tries. Tasks gather the runs of several
   blocks of text before they send them and again before they count: then all runs advance together, byte by
   byte, and accepting states are added up; the counts are summed by ranges of phrase numbers.
3. Scores, cuts, containment and ranks are DataFrame work on exact decimals; a language's phrases are ranked in
   ``SHARES`` shares first.

Null texts are empty, a null language is ``und``. Repeated rows count as often as they occur, and an empty
table gives an empty result. Equal runs of a block of text, and equal candidates of a task, are told by 64-bit
numbers. A long text is worked on in slices that end where a piece ends, so no phrase is lost. Columns other than text and language play no part. A hot phrase costs one entry per task and step.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from plaudit.llm.common import blocks_of, texts_of
from plaudit.llm.phrase_trie import BREAK, Trie, Words, build, plain_words, words_in
from plaudit.storage import materialise, together, work_path

LEAST = 10
LONGEST = 3
KEEP = 2000
BLOCK_BYTES = 1 << 20  # text worked on at once
HELD = 1_000_000  # bucket numbers a task holds before it packs them
HELD_BYTES = 4 << 20  # of phrases or runs that a task gathers before it sends or counts them
PART_BYTES = 8 << 20  # of text for each range of bucket numbers
BUCKET_BITS = 48
BUCKET_BYTES = 16 << 20
TRIE_BYTES = 1 << 20
WAVE = 4  # tries counted in one job; two jobs run at a time
SIEVE_BITS = 29  # of a bitmap of all bucket numbers, at most
SENT_BITS = 21  # of the places for numbers of phrases that a task has sent
RANGE = 1 << 16  # phrase numbers summed in one group
SHARES = 64  # of a language's phrases, ranked by themselves first

_SYMBOL = np.random.default_rng(2).integers(0, 1 << 64, 256, dtype=np.uint64)
_FACTOR = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class PhraseHashes:
    """64-bit numbers of runs of words, from running sums over the bytes of a block."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def _reach(self, size: int) -> None:
        if len(self.powers) < size:
            def powers(factor: int) -> np.ndarray:
                out = np.full(size, factor, dtype=np.uint64)
                out[0] = 1
                return np.cumprod(out)

            self.powers, self.inverse = powers(_FACTOR), powers(pow(_FACTOR, -1, 1 << 64))

    def of(
        self, words: Words, salt: np.uint64, longest: int, shortest: int = 2,
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Hash, first word and last word of all runs of ``shortest`` words, then of one more, and so on."""
        self._reach(len(words.raw) + 1)
        sums = np.zeros(len(words.raw) + 1, dtype=np.uint64)
        np.cumsum(_SYMBOL[words.raw] * self.powers[:len(words.raw)], out=sums[1:])
        whole = ~words.last
        run = np.ones(len(whole), dtype=bool)
        for length in range(1, longest + 1):
            if length > 1:
                run = run[:-1] & whole[length - 2:-1]
            if length < shortest:
                continue
            first = np.flatnonzero(run)
            start, end = words.start[first], words.end[first + length - 1]
            value = (sums[end] - sums[start]) * self.inverse[start] ^ salt
            value ^= value >> np.uint64(29)
            value *= np.uint64(0xBF58476D1CE4E5B9)
            value ^= value >> np.uint64(32)
            value *= np.uint64(0x94D049BB133111EB)
            yield value ^ (value >> np.uint64(31)), first, first + length - 1


def _slices(text: bytes, limit: int) -> Iterator[bytes]:
    """The text in slices of about ``limit`` bytes that end at a mark which ends a piece."""
    begin = 0
    while len(text) - begin > limit:
        at = begin + limit
        cut = min((p for p in (text.find(mark, at) for mark in (b"\n", b".", b",", b";", b":", b"!", b"?")) if p >= 0), default=-1)
        if cut < 0:
            break
        yield text[begin:cut]
        begin = cut + 1
    yield text[begin:]


_PLAIN = StructType([
    StructField("lang", StringType()), StructField("words", BinaryType()), StructField("size", LongType())])


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as plain words, one row per language and block of text."""
    held: dict[bytes, list[bytes]] = {}
    sizes: dict[bytes, int] = {}

    def flush(name: bytes) -> Iterator[pa.RecordBatch]:
        texts = held.pop(name)
        del sizes[name]
        whole = max(map(len, texts)) <= 2 * BLOCK_BYTES
        for block in [texts] if whole else [[part] for text in texts for part in _slices(text, BLOCK_BYTES)]:
            words = plain_words(block).tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array([name.decode()], pa.string()), pa.array([words], pa.binary()), pa.array([len(words)], pa.int64())],
                names=_PLAIN.names)

    for batch in blocks_of(batches, "text", BLOCK_BYTES):
        for text, name in zip(texts_of(batch.column(0)), texts_of(batch.column(1))):
            held.setdefault(name, []).append(text)
            sizes[name] = sizes.get(name, 0) + len(text) + 1
            if sizes[name] >= BLOCK_BYTES:
                yield from flush(name)
        if sum(sizes.values()) >= 4 * BLOCK_BYTES:
            for name in list(held):
                yield from flush(name)
    for name in list(held):
        yield from flush(name)


def _word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, bytes]]:
    """Words of blocks of text and their language."""
    for batch in batches:
        for name, blob in zip(texts_of(batch.column(0)), batch.column(1)):
            content = blob.as_buffer()
            if content.size:
                yield words_in(np.frombuffer(content, dtype=np.uint8)), name
        del batch
        pa.default_memory_pool().release_unused()


def _salt(language: bytes) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.sha256(language).digest()[:8], "little"))


def _packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane after byte plane, which compresses well; then the counts."""
    steps = np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    return steps.T.tobytes() + counts.astype(np.uint8).tobytes()


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    many = len(blob) // 9
    planes = np.frombuffer(blob, dtype=np.uint8, count=8 * many).reshape(8, many)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel()), np.frombuffer(blob, dtype=np.uint8, offset=8 * many)


_BUCKETS = StructType([
    StructField("part", IntegerType()), StructField("lang", StringType()), StructField("n", LongType()),
    StructField("packed", BinaryType())])
_TOTALS = -1  # the part that carries words per language


def _bucket_counts(texts: DataFrame, least: int, longest: int, part_bits: int) -> DataFrame:
    """Per part of the bucket numbers, the sorted ones that hold ``least`` phrases or more; and words per language."""
    shift = np.uint64(64 - part_bits)
    low = np.uint64((1 << 64 - part_bits) - 1)
    drop = np.uint64(64 - BUCKET_BITS)
    enough = min(least, 255)  # a count takes a byte

    def rows(parts, languages, numbers, blobs) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(parts, pa.int32()), pa.array(languages, pa.string()), pa.array(numbers, pa.int64()),
            pa.array(blobs, pa.binary())], names=_BUCKETS.names)

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        parts = (values >> shift).astype(np.int64)
        values = (values & low) >> drop
        counts = np.minimum(counts, enough)
        cuts = np.flatnonzero(np.diff(parts, prepend=-1)).tolist() + [len(parts)]
        blobs = [_packed(values[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        none = [None] * len(blobs)
        yield rows(parts[cuts[:-1]].tolist(), none, none, blobs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PhraseHashes()
        held: list[np.ndarray] = []
        totals: dict[bytes, int] = {}
        size = 0
        for words, language in _word_blocks(batches):
            totals[language] = totals.get(language, 0) + len(words.start)
            for value, _, _ in hashes.of(words, _salt(language), longest):
                held.append(value >> drop << drop)
                size += len(value)
            if size >= HELD:
                yield from flush(held)
                size = 0
        if size:
            yield from flush(held)
        if totals:
            yield rows([_TOTALS] * len(totals), [t.decode() for t in totals], list(totals.values()), [None] * len(totals))

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() == _TOTALS:
            summed = table.group_by("lang").aggregate([("n", "sum")])
            names, numbers = summed.column("lang").to_pylist(), summed.column("n_sum").to_pylist()
            return pa.Table.from_batches([rows([_TOTALS] * len(names), names, numbers, [None] * len(names))])
        # Numbers with their counts in the lowest byte, so that one sort without an order to apply will do.
        values = np.concatenate([v << np.uint64(8) | c for blob in table.column("packed") for v, c in [_unpacked(blob.as_buffer())]])
        values.sort()
        counts = (values & np.uint64(255)).astype(np.int64)
        values >>= np.uint64(8)
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        kept = values[first][np.add.reduceat(counts, first) >= enough]
        part = key[0].as_py()
        found = (np.uint64(part) << shift) | (kept << drop)
        return pa.Table.from_batches([rows([part], [None], [len(kept)], [found.tobytes()])])

    return texts.mapInArrow(count, _BUCKETS).groupBy("part").applyInArrow(add, _BUCKETS)


class Sieve:
    """A bitmap of the highest bits of bucket numbers; what it lets through may still be in no bucket."""

    def __init__(self, buckets: int):
        bits = min(SIEVE_BITS, max(10, buckets.bit_length() + 3))
        self.shift = np.uint64(64 - bits)
        self.bitmap = np.zeros(1 << bits - 3, dtype=np.uint8)

    def add(self, values: np.ndarray) -> None:
        place = values >> self.shift
        np.bitwise_or.at(self.bitmap, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    def holds(self, values: np.ndarray) -> np.ndarray:
        place = values >> self.shift
        return self.bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values, a place of each and how often it occurs; much faster than ``np.unique`` with places."""
    order = np.argsort(values)
    ordered = values[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(values)])
    return ordered[first], order[first], np.diff(first, append=len(values))


class Sent:
    """Remembers numbers in as many places as there are; forgets one where another takes its place."""

    def __init__(self):
        self.places = np.zeros(1 << SENT_BITS, dtype=np.uint64)
        self.places[0] = 1  # no number is where it would be looked for

    def new(self, given: np.ndarray) -> np.ndarray:
        """Places in ``given`` of numbers that are not remembered, by number, each once; these are remembered now."""
        some = np.flatnonzero(self.places[given & np.uint64(len(self.places) - 1)] != given)
        number, first, _ = _distinct(given[some])
        self.places[number & np.uint64(len(self.places) - 1)] = number
        return some[first]


def _strings(content: np.ndarray, length: np.ndarray) -> pa.Array:
    """Byte strings of these lengths that stand one after another."""
    offsets = np.zeros(len(length) + 1, dtype=np.int32)
    np.cumsum(length, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(content)])


def _gathered(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bytes of these stretches, one after another."""
    stop = np.cumsum(length)
    return raw[np.repeat(start - (stop - length), length) + np.arange(int(length.sum()))]


_PHRASES = StructType([StructField("lang", StringType()), StructField("phrase", StringType())])
_MET = StructType([
    StructField("part", IntegerType()), StructField("lang", StringType()), StructField("numbers", BinaryType()),
    StructField("lengths", BinaryType()), StructField("phrases", BinaryType())])


def _candidates(texts: DataFrame, buckets: DataFrame, sieve: Broadcast, longest: int, part_bits: int) -> DataFrame:
    """Phrases of these buckets, each once."""
    shift = np.uint64(64 - part_bits)
    drop = np.uint64(64 - BUCKET_BITS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, gone = PhraseHashes(), Sent()
        held: dict[bytes, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for language, found in held.items():
                number, length, content = map(np.concatenate, zip(*found))
                order = np.argsort(number)
                content = _strings(content, length).take(pa.array(order)).buffers()[2]
                number, length = number[order], length[order]
                part = (number >> shift).astype(np.int32)
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                at = np.concatenate([[0], np.cumsum(length)])[np.append(cuts, len(part))].tolist()
                part, cuts = part[cuts], [*cuts.tolist(), len(part)]
                each = list(zip(cuts[:-1], cuts[1:]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(part), pa.array([language.decode()] * len(part), pa.string()),
                    pa.array([number[a:b].tobytes() for a, b in each], pa.binary()),
                    pa.array([length[a:b].tobytes() for a, b in each], pa.binary()),
                    pa.array([content[a:b].to_pybytes() for a, b in zip(at[:-1], at[1:])], pa.binary())], names=_MET.names)
            held.clear()

        for words, language in _word_blocks(batches):
            for value, first, last in hashes.of(words, _salt(language), longest):
                near = np.flatnonzero(sieve.value.holds(value))
                place = near[gone.new(value[near])]
                if len(place):
                    start = words.start[first[place]]
                    length = (words.end[last[place]] - start).astype(np.int32)
                    content = _gathered(words.raw, start, length)
                    held.setdefault(language, []).append((value[place], length, content))
                    size += len(content) + 12 * len(place)
            if size >= HELD_BYTES:
                yield from flush()
                size = 0
        yield from flush()

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        wanted = np.empty(0, dtype=np.uint64)
        sent: dict[str, list[tuple[np.ndarray, pa.Array]]] = {}
        for language, numbers, lengths, phrases in zip(*(table.column(c) for c in _MET.names[1:])):
            number = np.frombuffer(numbers.as_buffer(), dtype=np.uint64)
            if not phrases.is_valid:
                wanted = number
            else:
                length = np.frombuffer(lengths.as_buffer(), dtype=np.int32)
                sent.setdefault(language.as_py(), []).append((number, _strings(phrases.as_buffer(), length)))
        out = [pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string())})]
        for language, found in sent.items() if len(wanted) else ():
            bucket = np.concatenate([number for number, _ in found]) >> drop << drop
            kept = wanted[np.minimum(np.searchsorted(wanted, bucket), len(wanted) - 1)] == bucket
            some = pa.concat_arrays([p for _, p in found]).filter(pa.array(kept)).unique().cast(pa.string())
            out.append(pa.table({"lang": pa.array([language] * len(some), pa.string()), "phrase": some}))
        return pa.concat_tables(out)

    none = F.lit(None).cast("binary")
    ranges = buckets.select(
        "part", F.lit(None).cast("string").alias("lang"), F.col("packed").alias("numbers"), none.alias("lengths"),
        none.alias("phrases"))
    return texts.mapInArrow(find, _MET).unionByName(ranges).groupBy("part").applyInArrow(meet, _PHRASES)


_TRIES = StructType([
    StructField("block", IntegerType()), StructField("number", IntegerType()), StructField("lang", StringType()),
    StructField("phrase", StringType()), StructField("trie", BinaryType())])


def _built(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The trie of a block of phrases as one row, and the phrases with their numbers."""
    languages, phrases = (table.column(name).combine_chunks() for name in ("lang", "phrase"))
    many = len(phrases)
    trie = pickle.dumps(build(languages, phrases), protocol=5)
    return pa.table({
        "block": pa.array([key[0].as_py()] * (many + 1), pa.int32()),
        "number": pa.concat_arrays([pa.array(np.arange(many), pa.int32()), pa.nulls(1, pa.int32())]),
        "lang": pa.concat_arrays([languages, pa.nulls(1, languages.type)]),
        "phrase": pa.concat_arrays([phrases, pa.nulls(1, phrases.type)]),
        "trie": pa.concat_arrays([pa.nulls(many, pa.binary()), pa.array([trie], pa.binary())])})


_COUNTS = StructType([
    StructField("block", IntegerType()), StructField("part", IntegerType()), StructField("counts", BinaryType())])
_NUMBERED = StructType([
    StructField("block", IntegerType()), StructField("number", IntegerType()), StructField("f", LongType())])


_STORED = StructType([
    StructField("lang", StringType()), StructField("words", BinaryType()), StructField("counts", BinaryType())])
_RUNS = StructType([StructField("block", IntegerType()), StructField("share", IntegerType()), *_STORED])


def _distinct_runs(
    words: Words, salt: np.uint64, longest: int, hashes: PhraseHashes, sieve: Sieve,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of distinct words and runs, the hash by which they are dealt, and their number."""
    lengths = hashes.of(words, salt, longest, shortest=1)
    value, _, _ = next(lengths)
    dealt, first, counts = _distinct(value)
    found = [(first, first, dealt, counts)]
    alive = np.ones(len(value), dtype=bool)
    last = np.arange(len(value))
    run, by_two = value, value.copy()
    for value, first, end in lengths:
        on = alive[first] & sieve.holds(value)
        value, first, end = value[on], first[on], end[on]
        alive = np.zeros(len(alive), dtype=bool)
        alive[first] = True
        run[first], last[first] = value, end
        two = end == first + 1
        by_two[first[two]] = value[two]
    start = np.flatnonzero(last > np.arange(len(last)))
    _, place, counts = _distinct(run[start])
    start = start[place]
    found.append((start, last[start], by_two[start], counts))
    return tuple(map(np.concatenate, zip(*found)))


def _dealt_runs(texts: DataFrame, sieve: Broadcast, blocks: int, shares: int, longest: int) -> DataFrame:
    """What the phrases of each block can occur in, a piece for each word or run, with its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PhraseHashes()
        share = TaskContext.get().partitionId()
        held: dict[bytes, dict[int, tuple[list[bytes], list[bytes]]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal share
            for language, of_block in held.items():
                share += 1
                many = len(of_block)
                yield pa.RecordBatch.from_arrays([
                    pa.array(list(of_block), pa.int32()), pa.array([share % shares] * many, pa.int32()),
                    pa.array([language.decode()] * many, pa.string()),
                    pa.array([b"".join(runs) for runs, _ in of_block.values()], pa.binary()),
                    pa.array([b"".join(counts) for _, counts in of_block.values()], pa.binary())], names=_RUNS.names)
            held.clear()

        for words, language in _word_blocks(batches):
            first, last, dealt, counts = _distinct_runs(words, _salt(language), longest, hashes, sieve.value)
            block = (dealt % np.uint64(blocks)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            block, counts = block[order], counts[order].astype(np.int32)
            start = words.start[first[order]]
            length = words.end[last[order]] + 1 - start
            content = _gathered(words.raw, start, length)
            stop = np.cumsum(length)
            content[stop - 1] = BREAK
            cuts = np.flatnonzero(np.diff(block, prepend=-1)).tolist() + [len(block)]
            stop = np.concatenate([[0], stop]).tolist()
            of_block = held.setdefault(language, {})
            for a, b in zip(cuts[:-1], cuts[1:]):
                runs, numbers = of_block.setdefault(int(block[a]), ([], []))
                runs.append(content[stop[a]:stop[b]].tobytes())
                numbers.append(counts[a:b].tobytes())
            size += len(content) + counts.nbytes
            if size >= HELD_BYTES:
                yield from flush()
                size = 0
        yield from flush()

    return texts.mapInArrow(run, _RUNS)


def _shard_counts(runs: DataFrame, block: int, sent: Broadcast) -> DataFrame:
    """Occurrences of the phrases of the pickled trie that was sent, per task and range of phrase numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie: Trie = pickle.loads(sent.value)
        counts = np.zeros(trie.phrases, dtype=np.int64)
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def count() -> None:
            for name, found in held.items():
                content, many = map(np.concatenate, zip(*found))
                trie.count(words_in(content), name.encode(), counts, many)
            held.clear()

        for batch in batches:
            for name, content, many in zip(*(batch.column(c) for c in ("lang", "words", "counts"))):
                content = np.frombuffer(content.as_buffer(), dtype=np.uint8)
                held.setdefault(name.as_py(), []).append((content, np.frombuffer(many.as_buffer(), dtype=np.int32)))
                size += len(content)
                if size >= HELD_BYTES:
                    count()
                    size = 0
        count()
        parts = [(i, counts[i:i + RANGE]) for i in range(0, len(counts), RANGE)]
        parts = [(i // RANGE, part.tobytes()) for i, part in parts if part.any()]
        if parts:
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * len(parts), pa.int32()), pa.array([i for i, _ in parts], pa.int32()),
                pa.array([blob for _, blob in parts], pa.binary())], names=_COUNTS.names)

    return runs.mapInArrow(run, _COUNTS)


def _summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    total = 0
    for blob in table.column("counts").to_pylist():
        total = total + np.frombuffer(blob, dtype=np.int64)
    some = np.flatnonzero(total)
    block, part = key[0].as_py(), key[1].as_py()
    return pa.table({
        "block": pa.array(np.full(len(some), block), pa.int32()), "number": pa.array(some + part * RANGE, pa.int32()),
        "f": pa.array(total[some], pa.int64())})


_DEALT = StructType([
    StructField("lang", StringType()), StructField("phrase", StringType()), StructField("block", IntegerType())])


def _blocked(keys: DataFrame, blocks: int) -> DataFrame:
    """Deals phrases to blocks by the hash of their first two words, and words by their own."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PhraseHashes()
        for batch in batches:
            for name in batch.column("lang").unique():
                phrases = batch.filter(pc.equal(batch.column("lang"), name)).column("phrase")
                words = words_in(np.frombuffer(b"".join(p + b"\n" for p in texts_of(phrases)), dtype=np.uint8))
                value = np.empty(len(words.start), dtype=np.uint64)
                for found, first, _ in hashes.of(words, _salt(name.as_py().encode()), 2, shortest=1):
                    value[first] = found
                begins = np.concatenate([[True], words.last[:-1]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([name.as_py()] * len(phrases), pa.string()), phrases,
                    pa.array((value[begins] % np.uint64(blocks)).astype(np.int32))], names=_DEALT.names)

    return keys.select("lang", "phrase").mapInArrow(deal, _DEALT)


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
    bucket_bytes: int = BUCKET_BYTES, trie_bytes: int = TRIE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f`` of all phrases that occur ``least`` times, and of their words; and ``lang, n``."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    # Every further step reads the words from here and cuts no text again.
    texts = materialise(texts.mapInArrow(_plain, _PLAIN), "plain-words")
    size = texts.agg(F.sum("size")).first()[0] or 0
    texts = texts.drop("size")
    part_bits = min(16, max(4, (size // PART_BYTES).bit_length()))
    buckets = materialise(_bucket_counts(texts, least, longest, part_bits), "phrase-buckets")
    totals = buckets.filter(F.col("part") == _TOTALS).select("lang", "n")

    buckets = buckets.filter((F.col("part") != _TOTALS) & (F.col("n") > 0))
    sizes = buckets.select("part", "n").orderBy("part").collect()
    if not sizes:
        return spark.createDataFrame([], "lang string, phrase string, f long"), totals
    sieve = Sieve(sum(row["n"] for row in sizes))
    block, held = [], 0
    for place, row in enumerate(sizes):
        block.append(row["part"])
        held += 8 * row["n"]
        if place + 1 == len(sizes) or held + 8 * sizes[place + 1]["n"] > bucket_bytes:
            for found in buckets.filter(F.col("part").between(block[0], block[-1])).select("packed").collect():
                sieve.add(np.frombuffer(found[0], dtype=np.uint64))
            block, held = [], 0
    sent_sieve = spark.sparkContext.broadcast(sieve)

    phrases = materialise(_candidates(texts, buckets, sent_sieve, longest, part_bits), "phrase-candidates")
    words = materialise(phrases.select("lang", F.explode(F.split("phrase", " ")).alias("phrase")).distinct(), "phrase-words")
    keys = phrases.unionByName(words)
    total = keys.agg(F.sum(F.octet_length("phrase") + F.octet_length("lang") + 1)).first()[0]
    blocks = -(-total // trie_bytes)
    tries = work_path(spark, "phrase-tries")
    _blocked(keys, blocks).groupBy("block").applyInArrow(_built, _TRIES).withColumn(
        "wave", F.floor(F.col("block") / WAVE).cast("int")).write.partitionBy("wave").parquet(tries)
    tries = spark.read.schema(StructType([*_TRIES, StructField("wave", IntegerType())])).parquet(tries)
    # A trie's runs lie in a folder of their own, in about as many files as there are cores.
    dealt = work_path(spark, "phrase-runs")
    _dealt_runs(texts, sent_sieve, blocks, spark.sparkContext.defaultParallelism, longest).repartition(
        "block", "share").write.option("compression", "zstd").partitionBy("block").parquet(dealt)
    sent_sieve.destroy()
    stored_runs = spark.read.schema(StructType([*_STORED, _RUNS["block"]])).parquet(dealt)
    path = work_path(spark, "phrase-shard-counts")

    def count(wave: int) -> list[str]:
        built = tries.filter((F.col("wave") == wave) & F.col("trie").isNotNull()).select("block", "trie").collect()
        sent = {}
        while built:
            block, trie = built.pop()
            sent[block] = spark.sparkContext.broadcast(trie)
            del trie
        counts = [_shard_counts(stored_runs.filter(F.col("block") == b).drop("block"), b, trie) for b, trie in sent.items()]
        if counts:
            reduce(DataFrame.unionByName, counts).groupBy("block", "part").applyInArrow(_summed, _NUMBERED).write.parquet(
                f"{path}/{wave}")
        for trie in sent.values():
            trie.destroy()
        return [f"{path}/{wave}"] if counts else []

    # Two waves at a time, so that one is planned while the other counts.
    paths = together(spark, [partial(count, wave) for wave in range(-(-blocks // WAVE))], at_once=2)
    counted = spark.read.schema(_NUMBERED).parquet(*[name for names in paths for name in names])
    named = tries.filter(F.col("number").isNotNull()).join(counted, ["block", "number"])
    return materialise(named.select("lang", "phrase", "f"), "phrase-counts"), totals


def mine_collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
    keep: int = KEEP, part_percent: int = 50, **sizes: int,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``keep`` best phrases per language.

    ``score`` is ``floor(1000000 a a / (l r))`` of the cut with the lowest such number, the earliest of equal
    ones. A phrase inside a longer one that occurs ``part_percent`` per cent as often or more is left out.
    """
    counts, totals = phrase_counts(docs, text, lang, least, longest, **sizes)
    of = F.split("phrase", " ")
    frequent = counts.withColumn("words", of).filter((F.size("words") > 1) & (F.col("f") >= least))

    def joined(begin, length):
        return F.array_join(F.slice("words", begin, length), " ")

    cuts = frequent.select(
        "lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"),
        joined(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"))
    firsts = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))

    def wide(column: str):
        return F.col(column).cast("decimal(13,0)")

    scored = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).withColumns({
        "above": wide("a") * wide("a") * F.lit(1000000).cast("decimal(7,0)"), "below": wide("l") * wide("r")})
    scored = scored.withColumn("score", F.expr("above div below")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # Every shorter phrase inside a longer one, with the longer one's count.
    inside = frequent.filter(F.size("words") > 2).select(
        "lang", "words", "f", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("length"))
    inside = inside.select(
        "lang", "words", "f", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("begin"))
    within = inside.select("lang", "f", joined(F.col("begin"), F.col("length")).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("f").alias("longer"))
    left = scored.join(within, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < part_percent * F.col("a")))

    # Only the best of each share of a language's phrases meet in one task.
    order = F.desc("score"), F.desc("a"), "phrase"
    ranked = left.select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"),
        F.pmod(F.hash("phrase"), F.lit(SHARES)).alias("share"))
    for of in (["lang", "share"], ["lang"]):
        best = Window.partitionBy(*of).orderBy(*order)
        ranked = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep)
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
