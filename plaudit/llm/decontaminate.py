"""Benchmark decontamination by an FM-index per shard of training documents.

A shard is a block of whole documents within one task (about 8 MB of text). Its words are indexed once;
all test phrases (windows of ``window`` consecutive words of an item, or the whole of a shorter item) are
searched backwards together, occurrences are located by sampled suffix positions, and their words merge
into removal spans. Words that no phrase has end a segment of the index.

Benchmarks are met in blocks of at most ``benchmark_bytes`` of text, which is what a task receives at
once; every further block is one more pass over the documents. There is no shuffle.

Null and empty texts have no words and no spans. A null item text has no phrases; an item without an id
is searched, but not listed. Repeated documents, and items with the same id, are each treated as given;
an id is listed once. Empty tables give empty results, an empty benchmark no spans. Input columns named
as a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from plaudit.llm.common import add_columns, merged_runs, plain, plain_words, texts_of
from plaudit.llm.fm_index import FmIndex

SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
FIELDS = [
    StructField("n_words", LongType()), StructField("spans", ArrayType(SPAN)),
    StructField("items", ArrayType(StringType()))]
#: Stands between documents of a shard; no plain word.
BREAK = b"."


class Phrases:
    """Distinct windows of benchmark items as rows of symbols, and the items that have them."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {BREAK: -1}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in plain_words((text or "").encode())]
            for start in range(max(1, len(words) - window + 1) if words else 0):
                owners = windows.setdefault(tuple(words[start:start + window]), set())
                if item is not None:
                    owners.add(item)
        self.lengths = np.array([len(w) for w in windows], dtype=np.int64)
        self.matrix = np.zeros((len(windows), window), dtype=np.int64)
        for row, symbols in enumerate(windows):
            self.matrix[row, :len(symbols)] = symbols
        self.owners = [sorted(o) for o in windows.values()]

    def spans(self, texts: list[bytes | None]) -> tuple[list[int], list[list], list[list]]:
        """Word count, merged spans and items of every document of a shard."""
        words = (b" " + BREAK + b" ").join(plain(t or b"") for t in texts).split()
        symbols = np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int64, count=len(words))
        del words
        symbols = np.append(symbols, -1)
        ends = np.flatnonzero(symbols == -1)
        starts = np.concatenate([[0], ends[:-1] + 1])
        symbols[ends] = 0
        spans: list[list] = [[] for _ in texts]
        items: list[list] = [[] for _ in texts]
        # Runs of separators are one separator.
        kept = np.flatnonzero((symbols != 0) | np.concatenate([[True], symbols[:-1] != 0]))
        index_of = symbols[kept]
        if len(self.lengths) and index_of.any():
            if index_of[-1] != 0:
                index_of, kept = np.append(index_of, 0), np.append(kept, len(symbols))
            index = FmIndex(index_of, len(self.vocabulary))
            low, high = index.search(self.matrix, self.lengths)
            many = np.maximum(high - low, 0)
            phrase = np.repeat(np.arange(len(many)), many)
            rows = np.arange(len(phrase)) - np.repeat(np.cumsum(many) - many, many) + low[phrase]
            at = kept[index.locate(rows)]
            document = np.searchsorted(starts, at, side="right") - 1
            order = np.lexsort((at, document))
            document, at, phrase = document[order], at[order] - starts[document[order]], phrase[order]
            cuts = np.flatnonzero(np.concatenate([[True], document[1:] != document[:-1]])) if len(at) else []
            for begin, end in zip(cuts, [*cuts[1:], len(at)]):
                mine = int(document[begin])
                spans[mine] = merged_runs(at[begin:end], self.lengths[phrase[begin:end]])
                items[mine] = sorted({i for p in np.unique(phrase[begin:end]) for i in self.owners[p]})
        return (ends - starts).tolist(), spans, items


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list]:
    """Items in blocks of at most ``limit`` bytes of text (a longer item is a block by itself)."""
    block: list = []
    size = 0
    for row in benchmark.select(F.col(item).cast("string"), F.col(text)).toLocalIterator():
        length = len((row[1] or "").encode())
        if block and size + length > limit:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += length
    yield block


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    benchmark_bytes: int = 4 << 20,
    shard_bytes: int = 8 << 20,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (merged word intervals to remove) and ``items`` (sorted ids)."""

    def searching(items: list, first: bool):
        def make():
            phrases = Phrases(items, window)

            def step(batch: pa.RecordBatch):
                counts, spans, ids = phrases.spans(texts_of(batch.column(0)))
                if not first:
                    for row, (old, listed) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                        if old:
                            both = [(s["start"], s["end"]) for s in old] + spans[row]
                            starts, ends = np.array(both, dtype=np.int64).T
                            spans[row] = merged_runs(starts, ends - starts)
                        ids[row] = sorted({*ids[row], *listed})
                return counts, [[{"start": a, "end": b} for a, b in s] for s in spans], ids

            return step

        return make

    found = docs
    for number, items in enumerate(benchmark_blocks(benchmark, item, item_text, benchmark_bytes)):
        needs = [text] if number == 0 else [text, "spans", "items"]
        found = add_columns(found, needs, FIELDS, searching(items, number == 0), shard_bytes)
    return found


def hit_words(spans: str = "spans"):
    """Number of words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
