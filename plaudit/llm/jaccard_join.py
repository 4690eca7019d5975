"""N-gram Jaccard self-join of documents by a MinHash LSH forest and exact verification.

1. Documents with the same words are one text, kept by its smallest id.
2. Every text gets ``TREES`` labels of ``DEPTH`` minima, ``BITS`` bits each. A label is a path of a prefix
   trie, so texts with a common prefix are neighbours in the order of labels. The matched prefix is
   shortened, from whole labels on, until texts at the threshold meet in some trie with the target recall.
3. Texts that meet are joined to the smallest of their prefix (never pair by pair); connected components
   of these links are the candidate groups.
4. A group's shingle sets are compared exactly, all against all, in squares of ``BLOCK`` x ``BLOCK`` texts,
   so that a big group is spread over many tasks. A square gives each text's number of links, and links
   enough to connect what is similar; no pairs are emitted.

Shingles are ``size`` consecutive plain words (lower-case letters, digits, characters beyond ASCII); a
shorter text with words is one shingle. Null, empty and word-free texts link with nothing. Documents with
a null id neither; their class is null. Rows with the same id and words count as copies; rows with one id
and different words share a class. Empty tables give empty results. Input columns named as a result
column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from plaudit.llm.common import add_columns, fresh, plain_words, texts_of
from plaudit.llm.components import components, in_squares, smallest_linked
from plaudit.llm.substring_dedup import WordHashes, window_hashes
from plaudit.storage import materialise

TREES, DEPTH, BITS = 20, 6, 10
BLOCK = 1024
COLUMNS = 8192
_draw = np.random.default_rng(20240917)
FACTORS = _draw.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)
SHIFTS = _draw.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)


def prefix_depth(threshold: float, recall: float) -> int:
    """The longest prefix at which texts of this similarity meet in one of the tries with this recall."""
    for depth in range(DEPTH, 1, -1):
        if 1 - (1 - threshold ** depth) ** TREES >= recall:
            return depth
    return 1


def shingles(texts: list[list[bytes]], size: int, memory: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, one after the other, and the number of each text."""
    counts = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    total = int(counts.sum())
    hashed = np.fromiter((memory[w] for words in texts for w in words), dtype=np.uint64, count=total)
    firsts, offsets = np.cumsum(counts) - counts, np.cumsum(many) - many
    values = np.empty(int(many.sum()), dtype=np.uint64)
    long_ = counts >= size
    if long_.any():
        repeat = np.where(long_, many, 0)
        inner = np.arange(int(repeat.sum())) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        values[np.repeat(offsets, repeat) + inner] = window_hashes(hashed, size)[np.repeat(firsts, repeat) + inner]
    for row in np.flatnonzero((counts > 0) & ~long_).tolist():
        values[offsets[row]] = xxhash.xxh3_64_intdigest(b" ".join(texts[row]))
    return values, many


def labels(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """One label per text and trie, the first minimum in the highest bits. Texts without shingles get 0."""
    found = np.zeros((len(many), TREES), dtype=np.int64)
    rows = np.flatnonzero(many)
    if not len(rows):
        return found
    starts = (np.cumsum(many) - many)[rows]
    short = (values >> np.uint64(32)).astype(np.uint32)
    for number in range(TREES * DEPTH):
        least = np.minimum.reduceat(short * FACTORS[number] + SHIFTS[number], starts)
        piece = (least * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        tree = number // DEPTH
        found[rows, tree] = (found[rows, tree] << BITS) | piece
    return found


def _sign(docs: DataFrame, doc_id: str, text: str, size: int, depth: int) -> DataFrame:
    """``doc_id, digest, prefixes`` of every document."""
    def make():
        memory = WordHashes()

        def step(batch: pa.RecordBatch):
            if len(memory) > 300_000:
                memory.clear()
            texts = [plain_words(t or b"") for t in texts_of(batch.column(0))]
            digests = [xxhash.xxh3_128_digest(b" ".join(words)) if words else None for words in texts]
            cut = labels(*shingles(texts, size, memory)) >> (BITS * (DEPTH - depth))
            return digests, cut.tolist()

        return step

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    fields = [StructField("digest", BinaryType()), StructField("prefixes", ArrayType(LongType()))]
    return add_columns(slim, ["text"], fields, make, 8 << 20).select("doc_id", "digest", "prefixes")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of 0/1 columns for hashes that several sets have."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    _, column = np.unique(column, return_inverse=True)
    result = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        table = np.zeros((len(sets), min(COLUMNS, width - start)), dtype=np.float32)
        table[owner[low:high], column[low:high] - start] = 1
        result += table @ table.T
    return result


def _verify(size: int, threshold: float):
    def run(square: pa.Table) -> pa.Table:
        ids = np.array(square["node"].to_pylist(), dtype=np.int64)
        order = np.argsort(ids, kind="stable")
        order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
        ids = ids[order]
        block = np.array(square["block"].to_pylist())[order]
        copies = np.array(square["copies"].to_pylist(), dtype=np.int64)[order]
        low, high = square["low"][0].as_py(), square["high"][0].as_py()
        contents = texts_of(square["text"])
        texts = [plain_words(contents[i] or b"") for i in order.tolist()]
        values, many = shingles(texts, size, WordHashes())
        sets = [np.unique(part) for part in np.split(values, np.cumsum(many)[:-1])]
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        common = _overlaps(sets).astype(np.float64)
        union = sizes[:, None] + sizes[None, :] - common
        linked = common >= threshold * union - 1e-9
        np.fill_diagonal(linked, False)
        if low != high:  # pairs within one block belong to the square of that block
            linked &= block[:, None] != block[None, :]
        a, b = np.nonzero(linked)
        root = smallest_linked(len(ids), a, b)
        return pa.table({
            "node": pa.array(ids), "root": pa.array(ids[root]),
            "links": pa.array((linked * copies[None, :]).sum(axis=1).astype(np.int64))})

    return run


def jaccard_join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
    threshold: float = 0.8, recall: float = 0.999, block: int = BLOCK,
) -> DataFrame:
    """``doc_id, class_id, n_links`` of every document.

    ``class_id`` is the smallest id reachable by links, ``n_links`` the number of other documents whose
    shingle sets have at least this Jaccard similarity, copies included.
    """
    signed = materialise(_sign(docs, doc_id, text, size, prefix_depth(threshold, recall)), "signed")
    texts = materialise(
        signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("prefixes").alias("prefixes")),
        "texts")
    met = texts.select("node", F.posexplode("prefixes").alias("tree", "prefix"))
    least = met.groupBy("tree", "prefix").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter(
        "least <> most").select("tree", "prefix", "least")
    stars = met.join(least, ["tree", "prefix"]).filter("node <> least").select(
        F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    contents = (
        docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
        .join(texts.select("node", "copies"), "node"))
    squares = in_squares(components(stars), contents, block)
    verified = materialise(
        squares.groupBy("component", "low", "high").applyInArrow(
            _verify(size, threshold), "node bigint, root bigint, links bigint"), "verified")
    joined = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = (
        verified.groupBy("node").agg(F.sum("links").alias("links"))
        .join(joined, "node", "left"))
    classes = (
        texts.select("digest", "node", "copies").join(links, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("class_id"),
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return (
        signed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
        .join(classes, "digest", "left")
        .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def keep_one_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without those whose class has a smaller id; of rows with one id, all stay."""
    number, kept = fresh(docs, "id_key"), fresh(docs, "is_first")
    first = jaccard_join(docs, doc_id, text, **options).filter("class_id < doc_id").select(
        F.col("doc_id").alias(number), F.lit(True).alias(kept)).distinct()
    marked = docs.withColumn(number, F.col(doc_id).cast("long"))
    return marked.join(first.select(number), number, "left_anti").select(*docs.columns)
