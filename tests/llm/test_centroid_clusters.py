from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import types as T

from plaudit.llm import centroid_clusters as cc

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("cluster", T.StringType())])


def plain(rows, dimensions, clusters, rounds):
    """Brute force over Python's integers."""
    kept = [(i, [cc._integer(x, 64) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    named = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(kept, key=named)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = [[v for _, v in kept if nearest(v)[1] == k] for k in range(len(centres))]
        centres = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, centres)]
    out = []
    for i, v in kept:
        distance, k = nearest(v)
        out.append((i, k, min(distance, cc.LARGEST), hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()))
    return sorted(out, key=repr)


def clustered(spark, rows, **options):
    found = cc.cluster_vectors(spark.createDataFrame(rows, SCHEMA), **options)
    assert found.columns == ["vec_id", "embedding", "cluster", "distance", "centroid_sha256"]
    return sorted(((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in found.collect()), key=repr)


def test_search_finds_the_nearest_and_saves_distances():
    rng = np.random.default_rng(3)
    centres = np.concatenate([rng.integers(-60, 60, (40, 6)), np.zeros((2, 6), dtype=np.int64)]).astype(np.int64)
    vectors = np.concatenate([centres[rng.integers(0, 42, 500)] + rng.integers(-3, 4, (500, 6)), rng.integers(-2, 3, (300, 6))])
    nearest, distance, computed = cc.Orchard(centres).assign(vectors)
    exact = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (nearest == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert computed < 0.7 * exact.size


def test_ties_at_twice_the_distance_go_to_the_smaller_number():
    centres = np.array([[10, 0], [0, 0], [20, 0]], dtype=np.int64)
    assert cc.Orchard(centres).assign(np.array([[5, 0], [15, 0], [10, 7]], dtype=np.int64))[0].tolist() == [0, 0, 0]


def test_clusters_equal_brute_force(spark):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(i % 4, 0.4) for _ in range(8)], "x") for i in range(150)]
    rows += rows[:20] + [(None, [0.5] * 8, None), (900, [0.0] * 8, "tie"), (901, [0.0] * 8, "tie")]
    rows += [(902, None, "n"), (903, [1.0] * 7, "short"), (904, [None] + [1.0] * 7, "hole"),
             (905, [float("nan")] * 8, "nan"), (906, [float("inf")] * 8, "inf")]
    assert clustered(spark, rows, dimensions=8, clusters=5) == plain(rows, 8, 5, 3)


def test_components_beyond_64_bits_are_exact(spark):
    rows = [(i, [1e30 * (i % 3), float(i), -2.5e7 * i], "x") for i in range(12)] + [(50, [1e300, -1e300, 0.1], "huge")]
    assert clustered(spark, rows, dimensions=3, clusters=4, rounds=2) == plain(rows, 3, 4, 2)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, [1.0, 2.0], "b"), (3, [-1.0, 0.0], "c")]
    assert clustered(spark, rows, dimensions=2, clusters=16) == plain(rows, 2, 16, 3)
    assert clustered(spark, [], dimensions=2) == []
    assert clustered(spark, [(1, None, "a")], dimensions=2) == []


def test_inertia(spark):
    rows = [(i, [float(i % 5), float(i // 7)], "x") for i in range(40)]
    found = cc.with_inertia(cc.cluster_vectors(spark.createDataFrame(rows, SCHEMA), dimensions=2, clusters=3)).collect()
    assert {r.inertia for r in found} == {sum(r.distance for r in found)}
    for r in found:
        assert r.cluster_inertia == sum(o.distance for o in found if o.cluster == r.cluster)
