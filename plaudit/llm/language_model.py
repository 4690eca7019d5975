"""LM scoring by context-tree weighting, with a word-frequency base line.

A text is its tokens: lower-cased (A-Z) words and one end. The tree models the bytes of the words, joined
by blanks, and the end symbol, so that both scores are logarithms of a probability of the same sequence.

1. A task cuts its documents into chunks of about ``chunk_bytes`` and stores, packed per hash bucket, the
   chunk's distinct words and byte sequences with their counts in training documents.
2. Word buckets add up, and every chunk gets the corpus counts of its words back.
3. Buckets of byte sequences, by the nearest three bytes, add up and weight the trees of their contexts, all of
   them, however rare. Only sums for contexts of two bytes leave a bucket; from these the driver weights the
   shorter contexts, whose number is bounded by the alphabet, and ships them to every task.
4. Buckets build their trees with that and answer every chunk's sequences with logarithms of probabilities, in
   single precision (a sum of them is off by less than 1e-7 of itself).
5. Chunks meet counts and answers and add them up.

Steps 3 and 4 stream a bucket's chunks; a task holds the distinct sequences of one bucket and their tree. The
most frequent three bytes are in one bucket, which grows with the distinct sequences after them.

A chunk is named by its content. The documents are read twice and must give the same chunks, so they have
to come from stored files; if they do not, the last step fails instead of scoring wrongly. Equal chunks of
several tasks share a name, their counts add up, and one of them is scored for all; they meet in one group,
which holds their texts.

Null and empty texts consist of the end alone. A null id is in training. Repeated rows count and are
scored each. Without training documents the tree gives every bit 1/2. Empty tables give empty results.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.llm import context_tree
from plaudit.llm.common import blocks_of, lower_ascii, spaced_words, texts_of
from plaudit.llm.context_tree import DEPTH, SPLIT, Top
from plaudit.llm.substring_dedup import WordHashes
from plaudit.storage import materialise

END_WORD = np.uint64(0x5DEECE66D1CE4E5B)
WORDS, STATS, TREE, GRAMS, TOP = range(5)  # a bucket's tree comes before what asks for it
SENT = "kind int, bucket int, chunk bigint, names binary, counts binary"
GATHERED = "kind int, bucket int, chunk bigint, names binary, counts binary, total bigint, known bigint"
TREES = "kind int, bucket int, names binary, counts binary, name bigint, zeros bigint, ones bigint, weighted double"
REPLY = "kind int, bucket int, chunk bigint, counts binary"
MERGED_AT = 1 << 20


def _packed(values: np.ndarray) -> bytes:
    """Byte planes of the steps between values, compressed."""
    size = values.dtype.itemsize
    steps = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, size).T).tobytes(), 1)


def _unpacked(content: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(content), dtype=np.uint8).reshape(size, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def _packed_counts(values: np.ndarray) -> bytes:
    """Byte planes of numbers that follow no order, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked_counts(content: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(content), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _packed_floats(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values.astype("<f4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked_floats(content: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(content), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<f4").ravel().astype(np.float64)


def chunk_name(batch: pa.RecordBatch) -> int:
    """A number for the ids and texts of a block, in their order."""
    name = xxhash.xxh3_64(str(batch.column("doc_id").to_pylist()).encode())
    for text in texts_of(batch.column("text")):
        name.update(b"-" if text is None else b"%d:" % len(text) + text)
    return name.intdigest() - (1 << 63)


class Chunk:
    """Token sequences of a block of documents."""

    def __init__(self, batch: pa.RecordBatch, memory: WordHashes, buckets: int):
        if len(memory) > 300_000:
            memory.clear()
        words = [spaced_words(lower_ascii(t or b"")) for t in texts_of(batch.column("text"))]
        self.ids = batch.column("doc_id")
        self.held = np.array(batch.column("held_out").to_pylist(), dtype=bool)
        self.counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        hashed = np.fromiter(
            map(memory.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=int(self.counts.sum()) - len(words))
        self.tokens = np.insert(hashed, np.cumsum(self.counts - 1), END_WORD)
        self.texts = [b" ".join(row) for row in words]
        self.bucket_of = lambda names: (names % np.uint64(buckets)).astype(np.int64)
        self.name = chunk_name(batch)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words by bucket, their number in training documents, and the word of every token."""
        names, place = np.unique(self.tokens, return_inverse=True)
        order = np.argsort(self.bucket_of(names), kind="stable")
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        place = back[place]
        trained = np.repeat(~self.held, self.counts)
        return names[order], np.bincount(place[trained], minlength=len(names)), place

    def counted_grams(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys by bucket, their buckets, and their number in training texts, as ``grams`` gives them.

        Keys have 56 bits, so whether a symbol is held out is sorted along with them, and no order is kept.
        """
        content, first, lengths = context_tree.stream_of(self.texts)
        keys = context_tree.keys_of(content, first, lengths)
        del content
        keys <<= 1
        keys |= np.repeat(~self.held, lengths)
        keys.sort()
        trained = (keys & 1).astype(np.int32)
        keys >>= 1
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        names = keys[heads]
        del keys
        trained = np.add.reduceat(trained, heads).astype(np.int64)
        bucket = _near(names, buckets)
        by_bucket = np.argsort(bucket, kind="stable")
        return names[by_bucket], bucket[by_bucket], trained[by_bucket]

    def grams(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys by bucket, their buckets, their number in training texts, the key of every symbol,
        and the number of symbols of every text."""
        content, first, lengths = context_tree.stream_of(self.texts)
        # Arrays of a number per symbol are the most a task holds, so they are let go as soon as possible. Keys are
        # numbered as they are met, and only the distinct ones are sorted.
        encoded = pa.array(context_tree.keys_of(content, first, lengths)).dictionary_encode()
        del content
        names, met = encoded.dictionary.to_numpy(), encoded.indices.to_numpy()
        del encoded
        trained = np.bincount(met[np.repeat(~self.held, lengths)], minlength=len(names))
        order = np.argsort(names)
        names, trained = names[order], trained[order]
        bucket = _near(names, buckets)
        by_bucket = np.argsort(bucket, kind="stable")
        back = np.empty(len(names), dtype=np.int32)
        back[order[by_bucket]] = np.arange(len(names))
        place = back[met]
        return names[by_bucket], bucket[by_bucket], trained[by_bucket], place, lengths


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal numbers in a sorted array."""
    present, first = np.unique(bucket, return_index=True)
    for number, low, high in zip(present.tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)]):
        yield number, slice(low, high)


def _near(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> (8 * (DEPTH + 1 - SPLIT))) * 2654435761 >> 13) % buckets


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _send(buckets: int, gram_buckets: int, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in blocks_of(batches, "text", chunk_bytes):
            chunk = Chunk(batch, memory, buckets)
            names, trained, _ = chunk.words()
            yield _batch([
                (WORDS, b, chunk.name, _packed(names[s]), _packed_counts(trained[s]))
                for b, s in _by_bucket(chunk.bucket_of(names))], SENT)
            keys, bucket, trained = chunk.counted_grams(gram_buckets)
            yield _batch([
                (GRAMS, b, chunk.name, _packed(keys[s]), _packed_counts(trained[s])) for b, s in _by_bucket(bucket)], SENT)

    return run


def _merged(names: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    every, place = np.unique(np.concatenate(names), return_inverse=True)
    return every, np.bincount(place, weights=np.concatenate(counts), minlength=len(every)).astype(np.int64), place


def _add_up(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    names = [_unpacked(r["names"], np.uint64) for r in rows]
    _, total, place = _merged(names, [_unpacked_counts(r["counts"]) for r in rows])
    out = [(STATS, rows[0]["bucket"], None, None, None, int(total.sum()), int(np.count_nonzero(total)))]
    found = np.split(total[place], np.cumsum([len(n) for n in names])[:-1])
    out += [(WORDS, r["bucket"], r["chunk"], None, _packed_counts(f), 0, 0) for r, f in zip(rows, found)]
    return pa.Table.from_batches([_batch(out, GATHERED)])


class Sum:
    """Counts of keys, added up part by part."""

    def __init__(self):
        self.names, self.counts, self.waiting = [], [], 0

    def add(self, names: np.ndarray, counts: np.ndarray) -> None:
        known = counts > 0
        self.names.append(names[known])
        self.counts.append(counts[known])
        self.waiting += len(self.names[-1])
        if self.waiting > max(MERGED_AT, len(self.names[0])):
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        names, counts, _ = _merged(self.names, self.counts)
        self.names, self.counts, self.waiting = [names], [counts], 0
        return names, counts


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by bucket to the bucket's counts, and what it adds to the decisions of short contexts."""
    def settled(bucket: int, counted: Sum) -> Iterator[pa.RecordBatch]:
        keys, counts = counted.merged()
        yield _batch([(TREE, bucket, _packed(keys), _packed_counts(counts), None, None, None, None)], TREES)
        short = context_tree.contributions(keys, counts)
        size = len(short[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, TOP, dtype=np.int32)), pa.array(np.full(size, bucket, dtype=np.int32)),
             pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()), *map(pa.array, short)],
            names=["kind", "bucket", "names", "counts", "name", "zeros", "ones", "weighted"])

    now, counted = None, Sum()
    for batch in batches:
        buckets, names, counts = (batch.column(c) for c in ("bucket", "names", "counts"))
        for row in range(batch.num_rows):
            bucket = buckets[row].as_py()
            if bucket != now:
                if now is not None:
                    yield from settled(now, counted)
                now, counted = bucket, Sum()
            counted.add(_unpacked(names[row].as_py(), np.int64), _unpacked_counts(counts[row].as_py()))
    if now is not None:
        yield from settled(now, counted)


def _answer(top: Top):
    """Rows by bucket, its tree first, to the logarithms of the probabilities of what each chunk asks for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = tree = values = None
        for batch in batches:
            kinds, buckets, chunks, names, counts = (
                batch.column(c) for c in ("kind", "bucket", "chunk", "names", "counts"))
            out = []
            for row in range(batch.num_rows):
                asked = _unpacked(names[row].as_py(), np.int64)
                if kinds[row].as_py() == TREE:
                    keys = tree = values = None
                    keys, tree = asked, top.extended(asked, _unpacked_counts(counts[row].as_py()))
                    values = tree.log_probability(keys)
                    continue
                found = np.empty(len(asked))
                place = np.searchsorted(keys, asked)
                place[place == len(keys)] = 0
                seen = keys[place] == asked if len(keys) else np.zeros(len(asked), dtype=bool)
                found[seen] = values[place[seen]]
                found[~seen] = tree.log_probability(asked[~seen])
                out.append((GRAMS, buckets[row].as_py(), chunks[row].as_py(), _packed_floats(found)))
            yield _batch(out, REPLY)

    return run


def _top(weighed: DataFrame) -> Top:
    found = weighed.filter(F.col("kind") == TOP).groupBy("name").agg(
        *[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")]).toArrow()
    name, zeros, ones, weighted = (found[c].to_numpy() for c in ("name", "zeros", "ones", "weighted"))
    order = np.argsort(name)
    return context_tree.top_of(name[order], zeros[order], ones[order], weighted[order])


def _score(buckets: int, gram_buckets: int, total: int, known: int):
    def run(key, documents: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(documents.combine_chunks().to_batches()[0], WordHashes(), buckets)
        names, _, place = chunk.words()
        keys, _, _, of_symbol, lengths = chunk.grams(gram_buckets)
        found = {(r["kind"], r["bucket"]): r for r in replies.to_pylist()}  # the same for equal chunks
        rows = [found[place] for place in sorted(found)]
        counts, values = (
            np.concatenate([np.zeros(0, kind), *[unpacked(r["counts"]) for r in rows if r["kind"] == which]])
            for which, kind, unpacked in (
                (WORDS, np.int64, _unpacked_counts), (GRAMS, np.float64, _unpacked_floats)))
        if chunk.name != key[0].as_py() or len(counts) != len(names) or len(values) != len(keys):
            raise RuntimeError("the documents changed between two reads; score a stored table")
        seen = counts[place].astype(np.float64)
        starts = np.cumsum(chunk.counts) - chunk.counts
        base = np.add.reduceat(np.log10((seen + 1) / (total + 1.0 * (known + 1))), starts)
        score = np.add.reduceat(values[of_symbol], np.cumsum(lengths) - lengths) / math.log(10)
        return pa.table({
            "doc_id": documents["doc_id"], "held_out": pa.array(chunk.held), "n_tokens": pa.array(chunk.counts),
            "n_known": pa.array(np.add.reduceat((seen > 0).astype(np.int64), starts)),
            "train_tokens": pa.array(np.full(len(starts), total)), "base_score": pa.array(base),
            "score": pa.array(score), "n_bytes": pa.array(lengths)})

    return run


RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double, n_bytes bigint")


def held_out(key, folds: int = 7, fold: int = 2):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == fold, F.lit(False))


def score_texts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    chunk_bytes: int = 6 << 20, bucket_bytes: int = 12 << 20, gram_bucket_bytes: int = 4 << 20,
) -> DataFrame:
    """Per document the columns of ``RESULT``; scores are log10 probabilities of the token sequence."""
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    buckets = max(64, size // bucket_bytes)
    gram_buckets = max(64, size // gram_bucket_bytes)
    sent = materialise(slim.mapInArrow(_send(buckets, gram_buckets, chunk_bytes), SENT), "chunk-counts")
    gathered = materialise(
        sent.filter(F.col("kind") == WORDS).groupBy("bucket").applyInArrow(_add_up, GATHERED), "corpus-counts")
    sums = gathered.filter(F.col("kind") == STATS).agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("known"), F.lit(0)).alias("known")).first()
    asked = sent.filter(F.col("kind") == GRAMS)
    weighed = materialise(
        asked.select("bucket", "names", "counts").repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_weigh, TREES), "corpus-trees")
    trees = weighed.filter(F.col("kind") == TREE).select(
        "kind", "bucket", F.lit(None).cast("long").alias("chunk"), "names", "counts")
    answers = (
        trees.unionByName(asked.withColumn("counts", F.lit(None).cast("binary")))
        .repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_answer(_top(weighed)), REPLY))
    replies = gathered.filter(F.col("kind") == WORDS).select("kind", "bucket", "chunk", "counts").unionByName(answers)

    def name_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(blocks_of(batches, "text", chunk_bytes)):
            size = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, chunk_name(batch))), pa.array(np.full(size, task + number)), *batch.columns,
                 pa.array(np.arange(size))],
                names=["chunk", "copy", "doc_id", "held_out", "text", "place"])

    named = slim.mapInArrow(
        name_chunks, "chunk bigint, copy bigint, doc_id bigint, held_out boolean, text string, place bigint")
    scored = _score(buckets, gram_buckets, sums["total"], sums["known"])

    def in_order(key, documents: pa.Table, replies: pa.Table) -> pa.Table:
        if not documents.num_rows:
            raise RuntimeError("the documents changed between two reads; score a stored table")
        copies = pc.unique(documents["copy"])
        one = documents.filter(pc.equal(documents["copy"], copies[0])).sort_by("place")
        return pa.concat_tables([scored(key, one, replies)] * len(copies))

    return named.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(in_order, RESULT)
