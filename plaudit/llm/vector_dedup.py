"""Embedding near-dedup by sorted projection passes.

1. Rows with the same vector are one, kept by the smallest id.
2. In every pass, vectors are ordered by a code of concatenated random hashes (signs of random
   projections, most significant first, of vectors less the mean of all) and compared with the next ``window``
   in that order. The number of passes grows with the rows, so that a pair at the threshold is expected to be
   found with probability ``RECALL`` at every size (see ``passes_for``); they run ``ROUND`` at a time. Verified
   neighbours are linked, and the links of all passes are united to candidate groups. The order is cut at
   the borders of tasks; pairs that a border separates are left to the other passes.
3. A group is compared exactly, all against all, in squares of ``block`` x ``block`` vectors, so that
   groups larger than a window lose no link and a big group is spread over many tasks.

Similarity is the cosine in double precision. Vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing; vectors of different dimension do not link either. Rows with a
null id link with nothing and are kept. Rows with one id and one vector count as copies. Empty tables
give empty results. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.llm.components import components, in_squares, smallest_linked
from plaudit.storage import materialise

WINDOW, BITS = 32, 60
RECALL, ROUND = 0.99, 16  # no fewer passes than one round
BLOCK = 1024


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: pa.Array) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that squares neither overflow nor vanish."""
    table = np.array(vectors.to_pylist(), dtype=np.float64)
    table /= np.abs(table).max(axis=1, keepdims=True)
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def passes_for(rows: int, shared: float, threshold: float, window: int = WINDOW) -> int:
    """Passes after which a pair at the threshold has been neighbours with probability ``RECALL``.

    ``shared`` is the squared length of the mean of the unit vectors; without the mean, a cosine of ``threshold``
    becomes the smaller one below. A pass finds a pair whose codes agree in so many leading signs that about
    ``window`` rows have them in common. Vectors that stay clustered without the mean may need more.
    """
    signs = math.log2(max(1.0, rows / window))
    if signs <= 1 or shared >= 1:
        return ROUND
    cosine = max(-1.0, min(1.0, (threshold - shared) / (1 - shared)))
    found = (1 - math.acos(cosine) / math.pi) ** signs
    return ROUND if found >= RECALL else max(ROUND, math.ceil(math.log(1 - RECALL) / math.log1p(-found)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and sum of the unit vectors of a task, by dimension."""
    found: dict = {}
    for batch in batches:
        sizes = np.array(batch.column("size").to_pylist())
        for size in np.unique(sizes).tolist():
            rows = pa.array(np.flatnonzero(sizes == size))
            many, total = found.get(size, (0, 0.0))
            found[size] = many + len(rows), total + unit_rows(batch.column("vector").take(rows)).sum(axis=0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int32()), pa.array([n for n, _ in found.values()], pa.int64()),
         pa.array([t.tolist() for _, t in found.values()], pa.list_(pa.float64()))], names=["size", "many", "total"])


def means(single: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """By dimension the number of vectors and the mean of the unit vectors."""
    sums: dict = {}
    tasks = single.select("size", "vector").mapInArrow(_sums, "size int, many bigint, total array<double>")
    for row in tasks.toLocalIterator():
        many, total = sums.get(row["size"], (0, 0.0))
        sums[row["size"]] = many + row["many"], total + np.array(row["total"])
    return {size: (many, total / many) for size, (many, total) in sums.items()}


def codes(table: np.ndarray, numbers: range, seed: int) -> np.ndarray:
    """One code per row and pass of these numbers."""
    found = np.zeros((len(table), len(numbers)), dtype=np.int64)
    for place, number in enumerate(numbers):
        planes = np.random.default_rng([seed, number, table.shape[1]]).standard_normal((table.shape[1], BITS))
        found[:, place] = (table @ planes > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
    return found


def _encode(numbers: range, seed: int, centres: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch.column("size").to_pylist())
            found: list = [None] * batch.num_rows
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                table = unit_rows(batch.column("vector").take(pa.array(rows))) - centres[size][1]
                for row, code in zip(rows, codes(table, numbers, seed)):
                    found[row] = code.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names, "codes"])

    return run


def _neighbours(window: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, table = [], np.zeros(0, np.int64), None
        for batch in batches:
            now = list(zip(batch.column("size").to_pylist(), batch.column("pass").to_pylist()))
            start = 0
            while start < len(now):  # one run of a pass and dimension at a time
                end = start
                while end < len(now) and now[end] == now[start]:
                    end += 1
                rows = unit_rows(batch.column("vector").slice(start, end - start))
                ids = np.array(batch.column("node").slice(start, end - start).to_pylist(), dtype=np.int64)
                if key == now[start]:
                    rows, ids = np.concatenate([table, rows]), np.concatenate([nodes, ids])
                a, b = [], []
                for step in range(1, min(window, len(ids) - 1) + 1):
                    near = np.flatnonzero(np.einsum("ij,ij->i", rows[:-step], rows[step:]) >= threshold)
                    a.append(near)
                    b.append(near + step)
                if a:
                    root = smallest_linked(len(ids), np.concatenate(a), np.concatenate(b))
                    linked = np.flatnonzero(root != np.arange(len(ids)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[linked]), pa.array(ids[root[linked]])], names=["a", "b"])
                key, nodes, table = now[start], ids[-window:], rows[-window:]
                start = end

    return run


def _compare(threshold: float):
    def run(square: pa.Table) -> pa.Table:
        ids = np.array(square["node"].to_pylist(), dtype=np.int64)
        order = np.argsort(ids, kind="stable")
        order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
        square = square.take(pa.array(order))
        ids = ids[order]
        block = np.array(square["block"].to_pylist())
        copies = np.array(square["copies"].to_pylist(), dtype=np.int64)
        table = unit_rows(square["vector"])
        linked = table @ table.T >= threshold
        np.fill_diagonal(linked, False)
        if square["low"][0].as_py() != square["high"][0].as_py():
            linked &= block[:, None] != block[None, :]
        root = smallest_linked(len(ids), *np.nonzero(linked))
        return pa.table({
            "node": pa.array(ids), "root": pa.array(ids[root]),
            "links": pa.array((linked * copies[None, :]).sum(axis=1).astype(np.int64))})

    return run


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
    passes: int | None = None, window: int = WINDOW, block: int = BLOCK, seed: int = 7,
) -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``. Without ``passes``, ``passes_for`` sets their number."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    valid = F.col("vec_id").isNotNull() & usable(F.col("vector"))
    single = materialise(
        rows.filter(valid).groupBy("vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .withColumn("size", F.size("vector")), "vectors")
    kind = single.schema["vector"].dataType.simpleString()
    centres = means(single)
    if passes is None:
        passes = max([ROUND, *[passes_for(n, float(mean @ mean), threshold, window) for n, mean in centres.values()]])
    order = ["size", "pass", "code", "node"]

    def linked(numbers: range) -> DataFrame:
        coded = single.select("node", "vector", "size").mapInArrow(
            _encode(numbers, seed, centres), f"node bigint, vector {kind}, size int, codes array<bigint>")
        ordered = coded.select("node", "vector", "size", F.posexplode("codes").alias("pass", "code")).repartitionByRange(
            *order).sortWithinPartitions(*order)
        return ordered.mapInArrow(_neighbours(window, threshold), "a bigint, b bigint")

    rounds = [range(first, min(first + ROUND, passes)) for first in range(0, passes, ROUND)]
    # Each round's links are stored, so that the disk holds the shuffle of one round at a time.
    found = [linked(numbers) for numbers in rounds] if len(rounds) == 1 else [
        materialise(linked(numbers), "neighbours") for numbers in rounds]
    candidates = reduce(DataFrame.unionByName, found)
    squares = in_squares(components(candidates), single, block)
    verified = materialise(squares.groupBy("component", "size", "low", "high").applyInArrow(
        _compare(threshold), "node bigint, root bigint, links bigint"), "verified")
    joined = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = (
        verified.groupBy("node").agg(F.sum("links").alias("links")).join(joined, "node", "left"))
    classes = single.join(found, "node", "left").select(
        F.col("vector"), F.coalesce("component", "node").alias("component"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    return (
        rows.withColumn("vector", F.when(valid, F.col("vector"))).join(classes, "vector", "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id"),
                F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept")))
