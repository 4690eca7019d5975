"""Centroid clustering of integer vectors with Orchard's search for the nearest centroid.

Vectors of the right length without null or non-finite components become integers, ``floor(scale * x)``.
The first centroids are the vectors whose ids hash lowest; every round assigns all vectors and moves each
centroid to the exact ``floor(sum / count)`` of its vectors, and a last pass assigns them once more.

A search walks the list of the other centroids by their distance from the best one so far, jumps to the
list of a better one as soon as it is found, compares no centroid twice, and stops when the next one lies
strictly beyond twice the current distance: nothing after it can be as near. Equal distances go to the
smaller number. All vectors of a batch walk their lists in step.

All sums and distances are exact integers, in 64 bits where they fit and in Python's integers where a
component is beyond ``2 ** 26``; a distance beyond 64 bits is given as the largest 64-bit number.

Only centroids travel to the tasks, and only sums per task and centroid come back into a shuffle; the
driver sees one row per centroid. Repeated rows count as often as they occur; a null id hashes as an empty
one, and rows of one hash start in the order of their vectors. With fewer vectors than centroids asked for
there are as many centroids as vectors; without any, the result is empty. Columns named as a result
column are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
#: Components up to this size keep squared distances of some thousand dimensions below 2 ** 63.
SMALL = 1 << 26
LIMB = 40  # bits of a sum that travel together
LARGEST = (1 << 63) - 1
BATCH_ROWS = 8192


def _integer(x: float, scale: int) -> int:
    return int(x) * scale if abs(x) >= 2.0 ** 53 else math.floor(x * scale)


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of doubles: 64-bit where all are small, else Python's integers."""
    if not values.size or np.abs(values).max() < SMALL / scale:
        return np.floor(values * scale).astype(np.int64)
    return np.array([[_integer(x, scale) for x in row] for row in values.tolist()], dtype=object)


def _widened(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as Python's integers if one of them is."""
    if vectors.dtype == centroids.dtype:
        return vectors, centroids
    return vectors.astype(object), centroids.astype(object)


def centroid_array(rows: Sequence[Sequence[int]]) -> np.ndarray:
    small = all(abs(value) <= SMALL for row in rows for value in row)
    return np.array(rows, dtype=np.int64 if small else object)


def squared(differences: np.ndarray) -> np.ndarray:
    return (differences * differences).sum(axis=-1)


class Orchard:
    """Nearest-centroid search over fixed centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.apart = squared(centroids[:, None, :] - centroids[None, :, :])
        number = len(centroids)
        #: The other centroids of each centroid, nearest first.
        self.lists = np.array([
            [j for j in sorted(range(number), key=lambda j: (self.apart[i, j], j)) if j != i] for i in range(number)
        ], dtype=np.int64).reshape(number, number - 1)

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid and squared distance of every vector, and the distances computed."""
        vectors, centroids = _widened(vectors, self.centroids)
        apart = self.apart if centroids is self.centroids else self.apart.astype(object)
        many = len(vectors)
        best = np.zeros(many, dtype=np.int64)
        distance = squared(vectors - centroids[0])
        visited = np.zeros((many, len(centroids)), dtype=bool)
        visited[:, 0] = True
        place = np.zeros(many, dtype=np.int64)
        computed = many
        walking = np.arange(many if self.lists.shape[1] else 0)
        while len(walking):
            now = best[walking]
            other = self.lists[now, place[walking]]
            within = (apart[now, other] <= 4 * distance[walking]).astype(bool)
            walking, other = walking[within], other[within]
            place[walking] += 1
            new = ~visited[walking, other]
            rows, candidate = walking[new], other[new]
            visited[rows, candidate] = True
            reach = squared(vectors[rows] - centroids[candidate])
            computed += len(rows)
            held = distance[rows]
            better = ((reach < held) | ((reach == held) & (candidate < best[rows]))).astype(bool)
            moved = rows[better]
            best[moved], distance[moved], place[moved] = candidate[better], reach[better], 0
            walking = walking[place[walking] < self.lists.shape[1]]
        return best, distance, computed


def kept_vectors(vectors: DataFrame, vector: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """Rows whose vector has ``dimensions`` components, all of them finite."""
    def broken(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return vectors.filter((F.size(vector) == dimensions) & ~F.exists(vector, lambda x: broken(x.cast("double"))))


def first_centroids(
    kept: DataFrame, id: str, vector: str, clusters: int, seed: int, scale: int = SCALE,
) -> np.ndarray:
    """The vectors whose ``seed:id`` has the lowest sha256, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))
    rows = kept.select(F.sha2(name, 256).alias("hash"), F.col(vector).alias("vector")).orderBy("hash", "vector").limit(clusters)
    found = [[_integer(float(x), scale) for x in row["vector"]] for row in rows.collect()]
    return centroid_array(found) if found else np.empty((0, 0), dtype=np.int64)


def _matrices(batch: pa.RecordBatch, column: str, dimensions: int, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and integer vectors of slices of a batch."""
    for begin in range(0, batch.num_rows, BATCH_ROWS):
        part = batch.column(column).slice(begin, BATCH_ROWS)
        values = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield begin, integers(values.reshape(-1, dimensions), scale)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """Signed digits of a number to the base ``2 ** LIMB``, from the lowest."""
    sign, rest, place = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        yield place, sign * (rest & ((1 << LIMB) - 1))
        rest >>= LIMB
        place += 1


def moved_centroids(kept: DataFrame, vector: str, centroids: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Centroids after one round; one without vectors stays."""
    number, dimensions = centroids.shape
    search = Orchard(centroids)
    schema = StructType([
        StructField("cluster", IntegerType()), StructField("limb", IntegerType()),
        StructField("n", LongType()), StructField("sums", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [0] * number
        sums = [[0] * dimensions for _ in range(number)]
        for batch in batches:
            for _, matrix in _matrices(batch, "vector", dimensions, scale):
                nearest = search.assign(matrix)[0]
                for cluster in np.unique(nearest).tolist():
                    mine = matrix[nearest == cluster]
                    counts[cluster] += len(mine)
                    sums[cluster] = [a + b for a, b in zip(sums[cluster], mine.sum(axis=0).tolist())]
        out: dict[tuple[int, int], list[int]] = {}
        for cluster, row in enumerate(sums):
            if counts[cluster]:
                out[cluster, 0] = [0] * dimensions
            for place, value in enumerate(row):
                for limb, digit in _limbs(value):
                    out.setdefault((cluster, limb), [0] * dimensions)[place] = digit
        if out:
            yield pa.RecordBatch.from_arrays([
                pa.array([c for c, _ in out], pa.int32()), pa.array([limb for _, limb in out], pa.int32()),
                pa.array([counts[c] if limb == 0 else 0 for c, limb in out], pa.int64()),
                pa.array(list(out.values()), pa.list_(pa.int64()))], names=schema.names)

    parts = kept.select(F.col(vector).alias("vector")).mapInArrow(run, schema)
    added = parts.groupBy("cluster", "limb").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dimensions)]).alias("sums"))
    counts = [0] * number
    sums = [[0] * dimensions for _ in range(number)]
    for row in added.collect():  # one row per centroid and limb
        counts[row["cluster"]] += row["n"]
        held = sums[row["cluster"]]
        for place, value in enumerate(row["sums"]):
            held[place] += value << (LIMB * row["limb"])
    return centroid_array([
        [total // counts[c] for total in sums[c]] if counts[c] else [int(v) for v in centroids[c]] for c in range(number)])


def assigned(kept: DataFrame, vector: str, centroids: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``kept`` with ``cluster``, ``distance`` (squared) and ``centroid_sha256``."""
    if not len(centroids):
        centroids = np.zeros((1, 1), dtype=np.int64)  # there is no vector to assign
    search = Orchard(centroids)
    digests = [hashlib.sha256(",".join(str(int(v)) for v in row).encode()).hexdigest() for row in centroids]
    fields = [StructField("cluster", IntegerType()), StructField("distance", LongType()), StructField("centroid_sha256", StringType())]
    new = {field.name for field in fields}
    columns = [c for c in kept.columns if c.lower() not in new]
    carried = "vector_in"
    while carried.lower() in {c.lower() for c in columns}:
        carried += "_"
    table = kept.select(*columns, F.col(vector).alias(carried))
    schema = StructType([table.schema[c] for c in columns] + fields)
    dimensions = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, matrix in _matrices(batch, carried, dimensions, scale):
                nearest, distance, _ = search.assign(matrix)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).slice(begin, len(matrix)) for c in columns],
                    pa.array(nearest, pa.int32()),
                    pa.array([min(int(d), LARGEST) for d in distance.tolist()], pa.int64()),
                    pa.array([digests[c] for c in nearest.tolist()], pa.string())], names=[*columns, *[f.name for f in fields]])

    return table.mapInArrow(run, schema)


def cluster_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1, scale: int = SCALE,
) -> DataFrame:
    """The kept rows of ``vectors`` with ``cluster``, ``distance`` and ``centroid_sha256`` of their final centroid."""
    kept = kept_vectors(vectors, vector, dimensions)
    centroids = first_centroids(kept, id, vector, clusters, seed, scale)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved_centroids(kept, vector, centroids, scale)
    return assigned(kept, vector, centroids, scale)


def with_inertia(found: DataFrame) -> DataFrame:
    """Adds ``cluster_inertia`` and ``inertia``: distances summed per cluster and over all, at most 2 ** 63 - 1.

    ``found`` is read twice, so it should be a written table. The sums are one row per cluster.
    """
    def capped(total: Column) -> Column:
        return F.least(total, F.lit(LARGEST).cast("decimal(38,0)")).cast("long")

    wide = F.sum(F.col("distance").cast("decimal(28,0)"))
    per_cluster = found.groupBy(F.col("cluster").alias("sum_of")).agg(wide.alias("part"))
    total = found.agg(wide.alias("total"))
    sums = per_cluster.join(F.broadcast(total), F.lit(True)).select(
        "sum_of", capped(F.col("part")).alias("cluster_inertia"), capped(F.col("total")).alias("inertia"))
    rest = found.drop("cluster_inertia", "inertia", "sum_of")
    return rest.join(F.broadcast(sums), F.col("cluster") == F.col("sum_of")).drop("sum_of")
