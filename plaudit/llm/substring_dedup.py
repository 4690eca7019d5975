"""Substring dedup by Rabin-Karp hashes of every window of ``window`` words.

1. A task hashes all windows of a block of its documents. Windows that a smaller document of the same
   block has are decided at once; for every other distinct hash the block sends the places in its smallest
   document, packed per hash bucket.
2. A bucket finds each hash's smallest document over all blocks; windows of larger ones are repeats.
3. A document's repeated windows come together and merge into maximal removal intervals.

A passage that a third of all documents share thus costs one entry a block, not one a document, and a
bucket holds a bounded share of all windows: buckets are as many as ``bucket_bytes`` go into the text.
Texts are compressed while they are shuffled to their intervals.
Hashes are polynomials modulo 2^64 over 64-bit word hashes; the chance that any two of n distinct windows
clash is below n^2 / 2^65.

Null and empty texts, and texts shorter than a window, keep all words. A null id is neither smaller nor
larger than any, so such documents stay whole. Rows with the same id never remove words from each other;
they are told apart by 16 bits of a hash of the text. Empty tables give empty results; input columns named
as a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from plaudit.llm.common import add_columns, blocks_of, fresh, merged_runs, spaced_words, texts_of

RADIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SENT = "bucket int, documents binary, hashes binary, places binary, starts array<int>"
KEYS = 1 << 16  # of texts; they tell rows with the same id apart
REPEATS = "id bigint, key bigint, starts array<int>"
SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _powers(base: np.uint64, count: int) -> np.ndarray:
    factors = np.full(count, base, dtype=np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Hash of every window of a sequence of word hashes."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(RADIX, len(words)), dtype=np.uint64)])
    values = (sums[window:] - sums[:-window]) * _powers(INVERSE, len(words) + 1 - window)
    values ^= values >> np.uint64(31)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def _planes(values: np.ndarray) -> bytes:
    """Steps between ascending values, byte plane by byte plane, compressed."""
    planes = np.diff(values, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 1)


def _from_planes(content: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(content), dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def _documents(ids: np.ndarray, firsts: np.ndarray, keys: np.ndarray) -> bytes:
    """Documents in the order of ids, column by column in steps, byte plane by byte plane, compressed."""
    columns = np.stack([np.diff(ids, prepend=0), np.diff(firsts, prepend=0), keys], axis=1).astype("<i8")
    return zstandard.compress(columns.view(np.uint8).reshape(len(ids), -1).T.tobytes(), 1)


def _from_documents(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(content), dtype=np.uint8).reshape(24, -1)
    columns = np.ascontiguousarray(planes.T).view("<i8").reshape(-1, 3)
    return np.cumsum(columns[:, 0]), np.cumsum(columns[:, 1]), columns[:, 2]


def _grouped_starts(owner: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Distinct owners, and the starts of each."""
    order = np.argsort(owner, kind="stable")
    owner, starts = owner[order], starts[order]
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, int)
    offsets = np.append(first, len(owner)).astype(np.int32)
    return owner[first], pa.ListArray.from_arrays(pa.array(offsets), pa.array(starts.astype(np.int32)))


def _send(window: int, buckets: int):
    fields = ["bucket", "documents", "hashes", "places", "starts"]
    types = [pa.int32(), *[pa.binary()] * 3, pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in batches:
            if len(memory) > 300_000:
                memory.clear()
            # By id, so that documents pack well.
            batch = batch.take(pc.sort_indices(batch.column("id")))
            texts = [spaced_words(t or b"") for t in texts_of(batch.column("text"))]
            counts = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            total = int(counts.sum())
            if total < window:
                continue
            hashed = np.fromiter((memory[w] for words in texts for w in words), dtype=np.uint64, count=total)
            del texts
            firsts = np.cumsum(counts) - counts
            ids = np.array(batch.column("id").to_pylist(), dtype=np.int64)
            keys = np.array(batch.column("key").to_pylist(), dtype=np.int64)
            # Windows within one document.
            many = np.maximum(counts - window + 1, 0)
            places = np.repeat(firsts - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            row = np.repeat(np.arange(len(counts)), many)
            values = window_hashes(hashed, window)[places]
            order = np.argsort(values)
            heads = np.flatnonzero(np.concatenate([[True], values[order][1:] != values[order][:-1]]))
            if not len(values):
                continue
            smallest = np.minimum.reduceat(ids[row[order]], heads)
            least = np.empty(len(values), dtype=np.int64)
            least[order] = np.repeat(smallest, np.diff(np.append(heads, len(values))))
            open_ = ids[row] == least
            done = np.flatnonzero(~open_)
            owners, starts = _grouped_starts(row[done], places[done] - firsts[row[done]])
            for mine, listed in zip(owners.tolist(), starts):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([
                    int(ids[mine] % buckets), _documents(ids[mine:mine + 1], np.zeros(1, np.int64), keys[mine:mine + 1]),
                    b"", b"", listed.as_py()], types)], names=fields)
            places, values = places[open_], values[open_]
            bucket = (values % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets <= 1 << 16 else None
            present = range(buckets) if cuts is not None else np.unique(bucket).tolist()
            for b in present:
                low, high = (cuts[b], cuts[b + 1]) if cuts is not None else np.searchsorted(bucket[order], [b, b + 1])
                if low == high:
                    continue
                mine = order[low:high]
                rows = np.unique(np.searchsorted(firsts, places[mine], side="right") - 1)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([
                    b, _documents(ids[rows], firsts[rows], keys[rows]),
                    values[mine].tobytes(), _planes(places[mine]), None], types)], names=fields)

    return run


def _decide(table: pa.Table) -> pa.Table:
    """Repeated windows of one bucket, by document."""
    all_ids, all_keys, all_starts = [], [], []
    hashes, documents, starts = [], [], []
    ids, keys, known = [], [], 0
    for row in table.to_pylist():
        row_ids, firsts, row_keys = _from_documents(row["documents"])
        if row["starts"] is not None:
            all_ids.append(row_ids)
            all_keys.append(row_keys)
            all_starts.append(pa.array([row["starts"]], pa.list_(pa.int32())))
            continue
        places = _from_planes(row["places"])
        document = np.searchsorted(firsts, places, side="right") - 1
        hashes.append(np.frombuffer(row["hashes"], np.uint64))
        starts.append((places - firsts[document]).astype(np.int32))
        documents.append(document + known)
        ids.append(row_ids)
        keys.append(row_keys)
        known += len(row_ids)
    if hashes:
        values, document, start = np.concatenate(hashes), np.concatenate(documents), np.concatenate(starts)
        names, marks = np.concatenate(ids), np.concatenate(keys)
        order = np.argsort(values)
        ordered = values[order]
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        owner = names[document[order]]
        smallest = np.repeat(np.minimum.reduceat(owner, heads), np.diff(np.append(heads, len(ordered))))
        again = order[owner > smallest]
        owners, listed = _grouped_starts(document[again], start[again])
        all_ids.append(names[owners])
        all_keys.append(marks[owners])
        all_starts.append(listed)
    return pa.table({
        "id": pa.array(np.concatenate(all_ids)), "key": pa.array(np.concatenate(all_keys)),
        "starts": pa.concat_arrays(all_starts)}) if all_ids else pa.table({
            "id": pa.array([], pa.int64()), "key": pa.array([], pa.int64()),
            "starts": pa.array([], pa.list_(pa.int32()))})


def repeated_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 50,
    block_bytes: int = 6 << 20, bucket_bytes: int = 12 << 20,
) -> DataFrame:
    """``id, key, starts``: word positions of windows that start in a smaller document, too."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    buckets = max(64, total // bucket_bytes)
    send = _send(window, buckets)

    def blocks(batches):
        return send(blocks_of(batches, "text", block_bytes))

    sent = (
        docs.select(F.col(doc_id).cast("long").alias("id"), F.pmod(F.xxhash64(text), F.lit(KEYS)).alias("key"), F.col(text).alias("text"))
        .filter(F.col("id").isNotNull())
        .mapInArrow(blocks, SENT))
    return (
        sent.groupBy("bucket").applyInArrow(_decide, REPEATS)
        .groupBy("id", "key").agg(F.flatten(F.collect_list("starts")).alias("starts")))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 50, **sizes: int,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` to remove, and ``kept_sha256`` of the kept words joined by blanks."""
    key, starts, number = (fresh(docs, n) for n in ("text_key", "window_starts", "id_key"))
    repeats = repeated_windows(docs, doc_id, text, window, **sizes).select(
        F.col("id").alias(number), F.col("key").alias(key), F.col("starts").alias(starts))
    packed = fresh(docs, "packed_text")

    def squeeze():
        press = zstandard.ZstdCompressor(level=1)
        return lambda batch: [[t if t is None else press.compress(t) for t in texts_of(batch.column(0))]]

    marked = docs.withColumn(key, F.pmod(F.xxhash64(text), F.lit(KEYS))).withColumn(number, F.col(doc_id).cast("long"))
    moved = add_columns(marked, [text], [StructField(packed, BinaryType())], squeeze).drop(text)
    joined = moved.join(repeats, [number, key], "left")
    fields = [
        StructField(text, StringType()),
        StructField("n_words", LongType()), StructField("spans", ArrayType(SPAN)),
        StructField("kept_sha256", StringType())]

    def make():
        press = zstandard.ZstdDecompressor()

        def step(batch: pa.RecordBatch):
            texts, counts, spans, digests = [], [], [], []
            for squeezed, places in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = squeezed if squeezed is None else press.decompress(squeezed)
                texts.append(content if content is None else content.decode())
                words = spaced_words(content or b"")
                runs = merged_runs(np.asarray(places.values), window) if places.is_valid else []
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in runs])
                for a, b in reversed(runs):
                    del words[a:b]
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            return texts, counts, spans, digests

        return step

    found = add_columns(joined, [packed, starts], fields, make, 4 << 20).drop(packed, key, number, starts)
    return found.select(*docs.columns, *[f.name for f in fields[1:] if f.name not in docs.columns])
