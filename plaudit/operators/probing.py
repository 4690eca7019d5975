"""Nearest vectors by multi-probe hashing with a target for the recall.

One hash table: the signs of ``b`` projections of a unit vector on orthogonal directions, ``b`` growing with the logarithm of
the corpus, so that a bucket keeps about ``ROWS_PER_BUCKET`` vectors. A query asks its own bucket and others
near it, in order of the probability that a neighbour lies there. For a neighbour at cosine c, a projection
is that of the query times c plus a normal term, so its sign differs with probability
``Phi(-c |x| / sqrt(v (1 - c^2)))``, v being the variance of a projection of a unit vector. A query asks buckets
until these probabilities add up to the target for its k-th neighbour, whose cosine is bounded from below by
the k-th best of a first round. Neighbours closer than the k-th are found with more.

Neighbouring buckets form cells. Both rounds bring the vectors of a cell and the queries that ask some of its
buckets together and score them as matrices, bucket by bucket; a cell with more than ``ROWS_PER_CELL`` vectors, as
copies make it, is cut into slices that meet the same queries. Only the k best of a query and slice go on to be
ranked. A query with fewer than k candidates after the first round asks every bucket there is.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.operators.similar import SCORE_DIGITS, Columns, best_of, unit_rows
from plaudit.storage import balanced, materialise

ROWS_PER_BUCKET = 32
CELL_BITS = 8  # a cell has two to this buckets
ROWS_PER_CELL = ROWS_PER_BUCKET << CELL_BITS
PAIR_CELLS = 4_000_000  # pairs scored at once
MOST_TASKS = 5000
MOST_BITS = 24
FIRST_SHARE = 8  # the first round asks one bucket in so many, eight at least


def bits_for(rows: int, dimensions: int) -> int:
    """Bits of a bucket for a corpus of this size."""
    return max(1, min(MOST_BITS, dimensions, round(math.log2(max(2.0, rows / ROWS_PER_BUCKET)))))


def directions(dimensions: int, bits: int, seed: int) -> np.ndarray:
    """Orthonormal random directions as columns."""
    drawn = np.random.default_rng([seed, dimensions]).standard_normal((dimensions, dimensions))
    return np.linalg.qr(drawn)[0][:, :bits]


def flip_chances(projections: np.ndarray, cosine: float, dimensions: int) -> np.ndarray:
    """Probability, per bit, that a vector at this cosine has the other sign."""
    if cosine >= 1.0:
        return np.zeros(len(projections))
    spread = math.sqrt(2.0 * max(1e-12, 1.0 - cosine * cosine) / dimensions)
    return np.array([0.5 * math.erfc(max(0.0, cosine) * abs(x) / spread) for x in projections])


def probes(projections: np.ndarray, chances: np.ndarray, target: float, most: int | None = None) -> Iterator[int]:
    """Buckets by falling probability, until these add up to ``target`` or there are ``most``.

    A set of flipped bits costs the sum of its bits' log odds; sets are made from cheaper ones by shifting
    or adding a bit, in the order of the bits' costs.
    """
    chances = np.clip(chances, 1e-12, 0.5)
    home = int(((projections > 0).astype(np.int64) << np.arange(len(projections))).sum())
    order = np.argsort(-chances, kind="stable")
    cost = np.log((1 - chances[order]) / chances[order])
    mask = 1 << order
    base = float(np.log1p(-chances).sum())
    yield home
    reached, given = math.exp(base), 1
    heap = [(float(cost[0]), 0, int(mask[0]))] if len(cost) else []
    while heap and reached < target and (most is None or given < most):
        spent, last, flips = heapq.heappop(heap)
        yield home ^ flips
        reached += math.exp(base - spent)
        given += 1
        if last + 1 < len(cost):
            after = int(mask[last + 1])
            heapq.heappush(heap, (spent + float(cost[last + 1]), last + 1, flips | after))
            heapq.heappush(heap, (spent - float(cost[last] - cost[last + 1]), last + 1, flips ^ int(mask[last]) | after))


def _units(df: DataFrame, key: str, vector: str, bits: int, seed: int) -> DataFrame:
    """``key``, unit vector, bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                units = unit_rows(batch[vector])
                signs = units @ directions(units.shape[1], bits, seed) > 0
                yield pd.DataFrame({key: batch[key], "_unit": list(units), "_bucket": signs @ (1 << np.arange(bits))})

    schema = T.StructType([
        df.schema[key], T.StructField("_unit", T.ArrayType(T.DoubleType())), T.StructField("_bucket", T.LongType())])
    return df.select(key, vector).mapInPandas(run, schema)


def _asked(queries: DataFrame, key: str, bits: int, seed: int, target: float, most: int | None) -> DataFrame:
    """``key, _cell, _buckets``: the buckets each query asks; ``_kth`` is the cosine its k-th neighbour has at least."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                unit = np.asarray(row[1], dtype=float)
                projections = unit @ directions(len(unit), bits, seed)
                # Without k candidates so far nothing is known of the k-th: every bucket is asked.
                unknown = pd.isna(row[2])
                chances = flip_chances(projections, 0.0 if unknown else float(row[2]), len(unit))
                found = np.sort(np.fromiter(probes(projections, chances, 2.0 if unknown else target, most), np.int64))
                cells, starts = np.unique(found >> CELL_BITS, return_index=True)
                yield pd.DataFrame({key: [row[0]] * len(cells), "_cell": cells, "_buckets": np.split(found, starts[1:])})

    schema = T.StructType([
        queries.schema[key], T.StructField("_cell", T.LongType()), T.StructField("_buckets", T.ArrayType(T.LongType()))])
    return queries.select(key, "_unit", "_kth").mapInPandas(run, schema)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Equally long lists as rows; a null component is NaN."""
    flat = np.asarray(pc.list_flatten(vectors).to_numpy(), dtype=float)
    return flat.reshape(len(vectors), len(flat) // len(vectors))


def _score_cell(held: pa.Table, asking: pa.Table, id_name: str, query_name: str, best: int | None) -> pa.Table:
    """Scored pairs of the vectors of a slice and the queries that ask their buckets; see :func:`_met`."""
    if not held.num_rows or not asking.num_rows:
        empty = [held[id_name].slice(0, 0), pa.array([], pa.float64()), pa.array([], pa.int64())]
        return pa.Table.from_arrays([asking[query_name].slice(0, 0), *empty], [query_name, id_name, "score", "tried"])
    held = held.take(pc.sort_indices(
        held, sort_keys=[("_bucket", "ascending"), (id_name, "ascending")], null_placement="at_start"))
    # Places in the order of the ids, by which equal scores rank.
    places = np.empty(held.num_rows, dtype=np.int64)
    places[pc.sort_indices(held, sort_keys=[(id_name, "ascending")], null_placement="at_start").to_numpy()] = np.arange(held.num_rows)
    vectors, queries = _matrix(held["_a"]), _matrix(asking["_b"])
    buckets, starts = np.unique(held["_bucket"].to_numpy(), return_index=True)
    ends = np.append(starts[1:], held.num_rows)
    lengths = pc.list_value_length(asking["_buckets"]).to_numpy()
    wanted, owners = pc.list_flatten(asking["_buckets"]).to_numpy(), np.repeat(np.arange(len(lengths)), lengths)
    step = max(1, PAIR_CELLS // held.num_rows)
    found = []
    for first in range(0, len(queries), step):
        mine = (owners >= first) & (owners < first + step)
        order = np.argsort(wanted[mine], kind="stable")
        asked, who = wanted[mine][order], owners[mine][order]
        low, high = np.searchsorted(asked, buckets), np.searchsorted(asked, buckets, side="right")
        parts = []
        for i in np.flatnonzero(high > low):
            rows = who[low[i]:high[i]]
            scores = np.round(queries[rows] @ vectors[starts[i]:ends[i]].T, SCORE_DIGITS)
            parts.append((np.repeat(rows, ends[i] - starts[i]), np.tile(np.arange(starts[i], ends[i]), len(rows)), scores.ravel()))
        if not parts:
            continue
        query, row, score = (np.concatenate(column) for column in zip(*parts))
        tried = np.ones(len(query), dtype=np.int64)
        if best is not None:
            order = np.lexsort((places[row], -score, query))
            query, row, score = query[order], row[order], score[order]
            heads = np.flatnonzero(np.diff(query, prepend=-1))
            counts = np.diff(np.append(heads, len(query)))
            kept = np.arange(len(query)) - np.repeat(heads, counts) < best
            tried = np.zeros(len(query), dtype=np.int64)
            tried[heads] = counts
            query, row, score, tried = query[kept], row[kept], score[kept], tried[kept]
        found.append(pa.Table.from_arrays(
            [asking[query_name].take(pa.array(query)), held[id_name].take(pa.array(row)),
             pa.array(score, from_pandas=True), pa.array(tried)], [query_name, id_name, "score", "tried"]))
    return pa.concat_tables(found) if found else _score_cell(held.slice(0, 0), asking, id_name, query_name, best)


def _met(corpus: DataFrame, queries: DataFrame, asked: DataFrame, names: Columns, best: int | None = None) -> DataFrame:
    """Scored pairs of queries and the vectors of the buckets they ask; each pair once.

    With ``best`` only so many per query and slice of a cell; ``tried`` adds up to the number of pairs scored.
    """
    cells = corpus.select(names.id, F.col("_unit").alias("_a"), "_bucket", F.shiftright("_bucket", CELL_BITS).alias("_cell"))
    slices = cells.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_CELL).alias("_slices"))
    left = cells.join(slices, "_cell").withColumn(
        "_slice", F.pmod(F.xxhash64(names.id), F.col("_slices"))).drop("_slices")
    right = (
        asked.join(queries.select(names.query_id, F.col("_unit").alias("_b")), names.query_id).join(slices, "_cell")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1))).drop("_slices"))
    schema = T.StructType([
        queries.schema[names.query_id], corpus.schema[names.id], T.StructField("score", T.DoubleType()),
        T.StructField("tried", T.LongType())])
    id_name, query_name = names.id, names.query_id

    def run(held: pa.Table, asking: pa.Table) -> pa.Table:
        return _score_cell(held, asking, id_name, query_name, best)

    # Few bytes, much work: sized by slices, not by what adaptive execution makes of the bytes.
    tasks = max(2 * corpus.sparkSession.sparkContext.defaultParallelism, int(slices.agg(F.sum("_slices")).first()[0] or 0))
    parts = [side.repartition(min(tasks, MOST_TASKS), "_cell", "_slice").groupBy("_cell", "_slice") for side in (left, right)]
    return parts[0].cogroup(parts[1]).applyInArrow(run, schema)


def probed_candidates(
    corpus: DataFrame, queries: DataFrame, k: int = 10, names: Columns = Columns(), target: float = 0.92, seed: int = 42,
    best: int | None = None,
) -> DataFrame:
    """``query_id, vec_id, score`` of all pairs that are compared, each once. Null vectors are left out.

    With ``best``, rows that cannot be among the so many best of their query are left out where they are scored,
    and ``tried`` adds up to the number of pairs compared. Query ids must be unique; rows of one corpus id are
    compared each.
    """
    vectors = corpus.select(names.id, names.vector).filter(F.col(names.vector).isNotNull())
    size = vectors.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size(names.vector)).alias("dimensions")).first()
    bits = bits_for(size["rows"], size["dimensions"] or 1)
    held = materialise(_units(vectors, names.id, names.vector, bits, seed), "hashed-corpus")
    wanted = materialise(_units(
        queries.select(names.query_id, names.vector).filter(F.col(names.vector).isNotNull()),
        names.query_id, names.vector, bits, seed), "hashed-queries")
    first = _asked(
        balanced(wanted.withColumn("_kth", F.lit(0.9))), names.query_id, bits, seed, 1.0, max(8, (1 << bits) // FIRST_SHARE))
    kth = best_of(_met(held, wanted, first, names, k), k, names).filter(F.col("rank") == k).select(
        names.query_id, F.col("score").alias("_kth"))
    asked = materialise(_asked(
        balanced(wanted.join(materialise(kth, "kth"), names.query_id, "left")), names.query_id, bits, seed, target, None), "probes")
    found = _met(held, wanted, asked, names, best)
    return found.drop("tried") if best is None else found


def nearest_probed(
    corpus: DataFrame, queries: DataFrame, k: int = 10, names: Columns = Columns(), target: float = 0.92, seed: int = 42,
) -> DataFrame:
    """:func:`plaudit.operators.similar.nearest` with an expected recall of ``target`` instead of certainty.

    ``query_id, vec_id, score, rank`` with rank <= k; scores are exact cosines.
    """
    return best_of(probed_candidates(corpus, queries, k, names, target, seed, best=k).drop("tried"), k, names)
