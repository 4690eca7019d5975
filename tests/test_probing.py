from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from plaudit.operators import probing, similar


def clustered(spark, rows, seed=3, dimensions=32):
    """Vectors near one of ``rows`` / 20 centres, as (vec_id, embedding)."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((rows // 20, dimensions))
    vectors = centres[np.arange(rows) % len(centres)] + 0.25 * rng.standard_normal((rows, dimensions))
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")


def measured(spark, corpus, k=10):
    queries = corpus.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    exact = {(r.query_id, r.vec_id): r.score for r in similar.nearest(corpus, queries, k).collect()}
    found = {(r.query_id, r.vec_id): r.score for r in probing.nearest_probed(corpus, queries, k).collect()}
    tried = probing.probed_candidates(corpus, queries, k)
    assert tried.count() == tried.select("query_id", "vec_id").distinct().count()
    assert all(abs(exact[pair] - found[pair]) <= 2e-6 for pair in exact.keys() & found.keys())
    return len(exact.keys() & found.keys()) / len(exact), tried.count() / (corpus.count() * queries.count())


def test_recall_is_reached_and_the_share_falls_with_the_corpus(spark):
    small, large = (measured(spark, clustered(spark, rows)) for rows in (1000, 8000))
    assert small[0] >= 0.9 and large[0] >= 0.9
    assert large[1] < 0.5 * small[1] and large[1] < 0.1


def test_buckets_come_by_falling_probability():
    rng = np.random.default_rng(1)
    projections = rng.standard_normal(7) / 8
    chances = probing.flip_chances(projections, 0.7, 64)
    home = sum(1 << i for i, x in enumerate(projections) if x > 0)

    def probability(bucket):
        return math.prod(p if (bucket ^ home) >> i & 1 else 1 - p for i, p in enumerate(chances))

    found = list(probing.probes(projections, chances, 2.0))
    assert sorted(found) == list(range(128)) and found[0] == home
    assert all(probability(a) >= probability(b) - 1e-12 for a, b in itertools.pairwise(found))
    part = list(probing.probes(projections, chances, 0.8))
    assert part == found[:len(part)]
    assert sum(map(probability, part)) >= 0.8 > sum(map(probability, part[:-1]))


def test_edges(spark):
    corpus = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [-1.0, 0.1])], "vec_id long, embedding array<double>")
    queries = corpus.withColumnRenamed("vec_id", "query_id")
    wanted = sorted(tuple(r) for r in similar.nearest(corpus, queries, 10).collect())
    assert sorted(tuple(r) for r in probing.nearest_probed(corpus, queries, 10).collect()) == wanted
    assert probing.nearest_probed(corpus.limit(0), queries, 3).count() == 0
    assert probing.nearest_probed(corpus, queries.limit(0), 3).count() == 0


def test_a_hot_vector_keeps_every_row(spark):
    same = spark.range(400).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0), F.lit(0.5)).alias("embedding"))
    other = clustered(spark, 200, dimensions=3).withColumn("vec_id", F.col("vec_id") + 1000)
    recall, _ = measured(spark, same.unionByName(other))
    assert recall >= 0.9


def test_slices_of_a_cell_keep_the_best_and_count_every_pair(spark, monkeypatch):
    corpus = clustered(spark, 600, dimensions=8)
    queries = corpus.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    pairs = probing.probed_candidates(corpus, queries, 5)
    wanted = sorted(tuple(r) for r in similar.best_of(pairs, 5).collect())
    monkeypatch.setattr(probing, "ROWS_PER_CELL", 40)
    monkeypatch.setattr(probing, "PAIR_CELLS", 200)
    kept = probing.probed_candidates(corpus, queries, 5, best=5)
    assert sorted(tuple(r) for r in similar.best_of(kept.drop("tried"), 5).collect()) == wanted
    assert kept.agg(F.sum("tried")).first()[0] == pairs.count() > kept.count()
