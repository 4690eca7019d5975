"""Token-id output: shards of one id array each, with Elias-Fano coded document boundaries.

Documents are range-partitioned by id (and text, so that even one id with a third of all rows is spread)
and sorted within partitions. A task cuts its documents into shards of about ``shard_bytes`` of text and
writes one record per shard: the concatenated ids, little-endian, two bytes each where the vocabulary
allows it, else four; the document ids; and the Elias-Fano code of the ends of documents in the id array.
Records lie in Parquet files, so that any store Spark writes to will do. Reading takes each document's
slice by ``select``; a shard's first global position comes from running sums over partitions, then over
the shards of a partition.

Words are encoded once and remembered; the tokenizer never joins what white space separates, so ids of a
text are the ids of its words. A mark beside an ASCII letter starts or ends a word, too, as the tokenizer
keeps the two apart. A worker that remembers too many words keeps those it met in a later block than the first.
Texts with the tokenizer's markers ``<|`` are encoded as a whole. Null and empty texts have the end id alone.
A null document id sorts first. Repeated rows are each written. Empty tables give empty files and results.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, compress, filterfalse, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plaudit.llm.common import blocks_of, lower_ascii, texts_of
from plaudit.llm.elias_fano import EliasFano

SHARD_SCHEMA = (
    "part int, shard int, id_bytes int, n_docs bigint, n_ids bigint, doc_ids array<bigint>, ends binary, ids binary")
#: Words whose ids a worker remembers at most.
REMEMBERED = 300_000
#: New words that are taken up at once; their pieces and ids are Python objects until they are stored.
LEARNED = 8192
#: Characters that the tokenizer keeps apart from letters, whatever stands around them.
MARKS = b".,;:!?*$#&%|()-\""
#: Lower-cases A-Z and turns the white space of ``bytes.split`` into blanks.
_SPACED = lower_ascii(bytes(32 if byte in b"\t\n\v\f\r" else byte for byte in range(256)))
#: ASCII letters 1, marks 2: where one stands beside the other, their kinds differ by 3.
_KINDS = bytes(2 if byte in MARKS else bytes([byte]).isalpha() for byte in range(256))


class WordEncoder:
    """Ids of texts, word by word, through a table of words met before."""

    def __init__(self, tokenizer: str, end_id: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.bytes_as_letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.id_bytes = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.end_id = end_id
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.first, self.many, self.met_again = array("I"), array("q"), array("i"), bytearray()

    def _forget_rare(self) -> None:
        """Keeps only words met in a later block than the one they were learned from; none, if these fill half."""
        known, flat, first, many, kept = self.known, self.flat, self.first, self.many, self.met_again
        self.forget()
        if 2 * sum(kept) > REMEMBERED:
            return
        places = compress(zip(first, many), kept)
        self._add(list(compress(known, kept)), list(compress(many, kept)), chain.from_iterable(
            flat[begin:begin + size] for begin, size in places))

    def _add(self, words: list[bytes], sizes: list[int], ids: Iterable[int]) -> None:
        self.known.update(zip(words, range(len(self.many), len(self.many) + len(words))))
        self.first.extend(accumulate(sizes[:-1], initial=len(self.flat)) if sizes else ())
        self.many.extend(sizes)
        self.flat.extend(ids)
        self.met_again.extend(bytes(len(words)))

    def _pieces(self, texts: Iterable[str]) -> tuple[list[int], Iterator[int]]:
        """Numbers of ids and ids of texts that are one piece each for the tokenizer's merges."""
        found = list(map(self.tokenizer.model.tokenize, texts))
        return list(map(len, found)), map(attrgetter("id"), chain.from_iterable(found))

    def _letters(self, words: list[bytes]) -> dict[bytes, str]:
        """The words of letters, each one piece for the tokenizer's merges, in the letters these are made of."""
        of_letters, others = {}, []
        for word in words:
            text = word.decode()
            if not text.isascii():
                others.append((word, text))
            elif text.isalpha():
                of_letters[word] = text
        others = [(word, text) for word, text in others if text.split() == [text]]
        # Blanks between them keep words apart in both steps; the second one writes a blank as the letter \u0120.
        normal = self.tokenizer.normalizer.normalize_str(" ".join(text for _, text in others)).split(" ")
        others = [(word, text) for (word, _), text in zip(others, normal, strict=True) if text.isalpha()] if others else []
        if others:
            mapped = self.bytes_as_letters.pre_tokenize_str(" ".join(text for _, text in others))[0][0].split("\u0120")
            of_letters.update(zip((word for word, _ in others), mapped, strict=True))
        return of_letters

    def _learn(self, words: list[bytes]) -> None:
        """Takes up new words. Marks around letters are pieces of their own, so each part is looked up alone."""
        plain = list(filter(bytes.isalpha, words))
        self._add(plain, *self._pieces(b" ".join(plain).decode().split()))
        words = list(filterfalse(bytes.isalpha, words))
        cores = [word.strip(MARKS) for word in words]
        letters = self._letters(list(dict.fromkeys(cores)))
        new = [word for word in letters if word not in self.known]
        self._add(new, *self._pieces(map(letters.__getitem__, new)))
        marks: dict[bytes, list[int]] = {b"": []}
        joined: dict[bytes, list[int]] = {}
        for word, core in zip(words, cores):
            if word in self.known:
                continue
            if core not in letters:
                joined[word] = self._whole(word)
                continue
            before, _, after = word.partition(core)
            for part in (before, after):
                if part not in marks:
                    marks[part] = self._whole(part)
            number = self.known[core]
            ids = self.flat[self.first[number]:self.first[number] + self.many[number]].tolist()
            joined[word] = marks[before] + ids + marks[after]
        self._add(list(joined), list(map(len, joined.values())), chain.from_iterable(joined.values()))

    def _whole(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with the end id after every text, and the ends of the texts in them."""
        marked = {row for row, text in enumerate(texts) if text and b"<|" in text}
        joined = b" ".join(b"" if not t or row in marked else t for row, t in enumerate(texts)).translate(_SPACED) + b" "
        kinds = np.frombuffer(joined.translate(_KINDS), dtype=np.uint8)
        cuts = np.flatnonzero(kinds[1:] ^ kinds[:-1] == 3) + 1
        raw = np.insert(np.frombuffer(joined, dtype=np.uint8), cuts, 32)
        starts = np.flatnonzero(np.diff(raw != 32, prepend=False))[::2]
        # A word with the blanks after it is one value, so the values lie in the text one after another.
        encoded = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
        words = encoded.dictionary.buffers()[2].to_pybytes().split() if len(starts) else []
        if len(self.known) > REMEMBERED:
            self._forget_rare()
        known = self.known
        number = np.fromiter(map(known.get, words, repeat(-1)), dtype=np.int32, count=len(words))
        np.frombuffer(self.met_again, np.uint8)[number[number >= 0]] = 1
        unknown = np.flatnonzero(number < 0)
        # A word stands here once for every number of blanks after it.
        missing = list(map(words.__getitem__, unknown.tolist()))
        new = list(dict.fromkeys(missing))
        for begin in range(0, len(new), LEARNED):
            self._learn(new[begin:begin + LEARNED])
        number[unknown] = np.fromiter(map(known.__getitem__, missing), dtype=np.int32, count=len(missing))
        number = number[encoded.indices.to_numpy()]
        begins = np.cumsum([0] + [1 if not t or row in marked else len(t) + 1 for row, t in enumerate(texts)])
        places = np.searchsorted(starts, begins + np.searchsorted(cuts, begins))
        del joined, kinds, cuts, raw, starts, encoded, words, unknown, missing, new
        # Views, gone before the arrays grow again.
        flat, first, many = (np.frombuffer(x, x.typecode) for x in (self.flat, self.first, self.many))
        sizes = many[number]
        before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        text_ids = np.diff(before[places])
        at = np.repeat(first[number] - before[:-1], sizes)
        at += np.arange(len(at))
        ids = flat[at]
        del at, before, number, sizes, flat, first, many
        ends = np.cumsum(text_ids)
        whole = {row: self._whole(texts[row]) for row in marked}
        if whole:
            ids = np.insert(ids, np.repeat([int(ends[r]) for r in whole], [len(v) for v in whole.values()]),
                            [i for v in whole.values() for i in v])
            for row, found in whole.items():
                text_ids[row] = len(found)
            ends = np.cumsum(text_ids)
        return np.insert(ids, ends, self.end_id), ends + np.arange(1, len(texts) + 1)


_encoders: dict[int, WordEncoder] = {}


def _encoder(tokenizer: str, end_id: int) -> WordEncoder:
    """One per worker process: what it remembers serves the next task, too."""
    key = hash((tokenizer, end_id))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(tokenizer, end_id)
    return _encoders[key]


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, key: str = "doc_id", text: str = "text",
    end_id: int = 1, shard_bytes: int = 2 << 20,
) -> None:
    """Writes the shards of ``docs`` in ascending order of ``key``."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, end_id)
        part = TaskContext.get().partitionId()
        for shard, batch in enumerate(blocks_of(batches, "text", shard_bytes)):
            ids, ends = encoder.encode(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([encoder.id_bytes], pa.int32()),
                pa.array([batch.num_rows], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([batch.column("key").to_pylist()], pa.list_(pa.int64())),
                pa.array([EliasFano.encode(ends)], pa.binary()),
                pa.array([ids.astype(f"<u{encoder.id_bytes}").tobytes()], pa.binary())],
                names=["part", "shard", "id_bytes", "n_docs", "n_ids", "doc_ids", "ends", "ids"])

    order = ["key", F.xxhash64("text")]
    (
        docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(run, SHARD_SCHEMA)
        .write.option("compression", "zstd").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32``: global start, ids, checksum of the ids as 32-bit."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    before = lambda window: F.coalesce(F.sum("n_ids").over(
        window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select(
        "part", before(Window.orderBy("part")).alias("part_base"))
    bases = (
        shards.select("part", "shard", "n_ids", before(Window.partitionBy("part").orderBy("shard")).alias("inner"))
        .join(parts, "part").select("part", "shard", (F.col("inner") + F.col("part_base")).alias("base")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in map(batch.slice, range(batch.num_rows), repeat(1)):
                boundaries = EliasFano(row.column("ends")[0].as_py())
                ends = boundaries.select(np.arange(boundaries.count))
                starts = np.concatenate([[0], ends[:-1]])
                width = row.column("id_bytes")[0].as_py()
                ids = np.frombuffer(row.column("ids")[0].as_buffer(), dtype=f"<u{width}").astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                place = [pa.repeat(row.column(name)[0], len(ends)) for name in ("part", "shard")]
                yield pa.RecordBatch.from_arrays([
                    *place, row.column("doc_ids").flatten(), pa.array(starts, pa.int64()),
                    pa.array(ends - starts, pa.int64()), pa.array(sums, pa.int64())],
                    names=["part", "shard", "doc_id", "inner_start", "n_tokens", "ids_crc32"])

    # Only the documents' figures are moved for the join, never their ids.
    found = shards.select("part", "shard", "id_bytes", "doc_ids", "ends", "ids").mapInArrow(
        run, "part int, shard int, doc_id bigint, inner_start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(bases, ["part", "shard"]).select(
        "doc_id", (F.col("inner_start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
