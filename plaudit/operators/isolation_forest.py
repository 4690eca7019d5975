"""Isolation forest (Liu, Ting and Zhou, 2008) on Spark.

Rows are first counted per distinct feature combination, which shrinks them by orders of magnitude
and makes hot combinations a single row. Trees grow in parallel, each in its own group of at most
``sample_size`` rows. Scoring is a narrow vectorised pass with the small, fixed-size forest broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.storage import materialise

SCORE_DIGITS = 6
TREE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()),
    T.StructField("feature", T.ArrayType(T.IntegerType())),
    T.StructField("cut", T.ArrayType(T.DoubleType())),
    T.StructField("left", T.ArrayType(T.IntegerType())),
    T.StructField("right", T.ArrayType(T.IntegerType())),
    T.StructField("depth", T.ArrayType(T.DoubleType())),
])


def mean_path(size) -> np.ndarray:
    """Average path length of an unsuccessful search among ``size`` points."""
    size = np.asarray(size, dtype=float)
    safe = np.maximum(size, 3)
    long = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(size <= 1, 0.0, np.where(size <= 2, 1.0, long))


def grow_tree(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> dict[str, list]:
    """Random binary tree over ``points`` as parallel node lists; leaves point at themselves."""
    feature, cut, left, right, depth = [], [], [], [], []

    def add(rows: np.ndarray, level: int) -> int:
        node = len(feature)
        feature.append(0)
        cut.append(math.inf)
        left.append(node)
        right.append(node)
        depth.append(level + float(mean_path(len(rows))))
        if level < max_depth and len(rows) > 1:
            low, high = points[rows].min(axis=0), points[rows].max(axis=0)
            varying = np.flatnonzero(high > low)
            if len(varying):
                axis = int(rng.choice(varying))
                at = float(rng.uniform(low[axis], high[axis]))
                below = points[rows, axis] <= at
                feature[node], cut[node] = axis, at
                left[node] = add(rows[below], level + 1)
                right[node] = add(rows[~below], level + 1)
        return node

    add(np.arange(len(points)), 0)
    return {"feature": feature, "cut": cut, "left": left, "right": right, "depth": depth}


@dataclass(frozen=True)
class Forest:
    """Trees padded to one rectangle, so that all of them descend together."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    levels: int
    sample_size: int

    @classmethod
    def from_rows(cls, rows: Sequence, levels: int, sample_size: int) -> Forest:
        width = max(len(row["feature"]) for row in rows)

        def table(name: str, kind) -> np.ndarray:
            out = np.zeros((len(rows), width), dtype=kind)
            for i, row in enumerate(rows):
                out[i, : len(row[name])] = row[name]
            return out

        return cls(
            table("feature", np.int64), table("cut", np.float64), table("left", np.int64),
            table("right", np.int64), table("depth", np.float64), levels, sample_size)

    def score(self, points: np.ndarray, block: int = 2048) -> np.ndarray:
        """Anomaly score in (0, 1), rounded; equal points are scored once."""
        if not len(points):
            return np.zeros(0)
        distinct, back = np.unique(points, axis=0, return_inverse=True)
        scores = np.concatenate([
            self._score_block(distinct[start:start + block]) for start in range(0, len(distinct), block)])
        return np.round(scores, SCORE_DIGITS)[back.reshape(-1)]

    def _score_block(self, points: np.ndarray) -> np.ndarray:
        trees, columns = np.arange(len(self.feature))[:, None], np.arange(len(points))[None, :]
        node = np.zeros((len(self.feature), len(points)), dtype=np.int64)
        for _ in range(self.levels):
            below = points[columns, self.feature[trees, node]] <= self.cut[trees, node]
            node = np.where(below, self.left[trees, node], self.right[trees, node])
        return 2.0 ** (-self.depth[trees, node].mean(axis=0) / float(mean_path(self.sample_size)))


def _draw_copies(rate: float, seed: int):
    """Binomial number of sampled copies of a combination, seeded by the combination itself."""

    @F.pandas_udf(T.LongType())
    def copies(token: pd.Series, rows: pd.Series) -> pd.Series:
        if rate >= 1.0:
            return rows.astype("int64")
        drawn = [
            np.random.Generator(np.random.Philox(key=[seed, int(t) & (2**64 - 1)])).binomial(int(n), rate)
            for t, n in zip(token, rows)
        ]
        return pd.Series(drawn, dtype="int64")

    return copies


class IsolationForest:
    """``fit`` learns trees and the score above which the ``contamination`` share lies."""

    def __init__(
        self,
        features: Sequence[str],
        trees: int = 100,
        sample_size: int = 256,
        contamination: float = 0.05,
        seed: int = 42,
    ):
        self.features = tuple(features)
        self.trees = trees
        self.sample_size = sample_size
        self.contamination = contamination
        self.seed = seed

    def fit(self, df: DataFrame) -> IsolationForestModel:
        points = df.select(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in self.features])
        counted = points.groupBy(*self.features).agg(F.count(F.lit(1)).alias("rows"))
        # Few bytes but much work per row: spread them over all cores, which adaptive execution,
        # looking at bytes alone, would not do.
        cores = df.sparkSession.sparkContext.defaultParallelism
        combinations = materialise(counted.repartition(cores), "feature-combinations")
        total = combinations.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if total == 0:  # nothing can stand out
            leaf = {"feature": [0], "cut": [0.0], "left": [0], "right": [0], "depth": [1.0]}
            return IsolationForestModel(df.sparkSession, self.features, Forest.from_rows([leaf], 1, 2), threshold=1.0)
        sample_size = min(self.sample_size, total)
        levels = max(1, math.ceil(math.log2(max(sample_size, 2))))
        grown = self._grow(self._samples(combinations, total, sample_size), levels).orderBy("tree").collect()
        forest = Forest.from_rows(grown, levels, sample_size)
        model = IsolationForestModel(df.sparkSession, self.features, forest, threshold=1.0)
        # At most 10^6 distinct rounded scores exist, so the exact percentile is cheap.
        histogram = (
            combinations.select(model.score(combinations).alias("score"), "rows")
            .groupBy("score").agg(F.sum("rows").alias("rows"))
        )
        model.threshold = histogram.agg(
            F.percentile("score", 1.0 - self.contamination, F.col("rows"))).first()[0]
        return model

    def _samples(self, combinations: DataFrame, total: int, sample_size: int) -> DataFrame:
        """``(tree, features)``: up to ``sample_size`` rows for every tree.

        A pool of about ``trees * sample_size`` rows is drawn from the counts; each tree takes
        the pool rows with the smallest tokens for its number. No row of the data is visited again.
        """
        pool_size = float(self.trees * sample_size)
        rate = min(1.0, pool_size / total)
        token = F.xxhash64(*self.features, F.lit(self.seed))
        pool = (
            combinations.withColumn("token", token)
            .withColumn("copies", _draw_copies(rate, self.seed)("token", "rows"))
            .filter("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(*self.features, "token", "copy")
        )
        per_tree = (
            pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1))))
            .withColumn("chance", F.xxhash64("token", "copy", "tree"))
        )
        order = Window.partitionBy("tree").orderBy("chance", "token", "copy")
        return (
            per_tree.withColumn("place", F.row_number().over(order))
            .filter(F.col("place") <= sample_size)
            .select("tree", "place", *self.features)
        )

    def _grow(self, samples: DataFrame, levels: int) -> DataFrame:
        features, seed = list(self.features), self.seed

        def grow(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("place")
            tree = int(group["tree"].iloc[0])
            rng = np.random.default_rng([seed, tree])
            nodes = grow_tree(group[features].to_numpy(dtype=float), rng, levels)
            return pd.DataFrame([{"tree": tree, **nodes}])

        cores = samples.sparkSession.sparkContext.defaultParallelism
        spread = samples.repartition(min(self.trees, cores), "tree")
        return spread.groupBy("tree").applyInPandas(grow, TREE_SCHEMA)


class IsolationForestModel:
    """A grown forest and its decision threshold."""

    def __init__(self, spark: SparkSession, features: Sequence[str], forest: Forest, threshold: float):
        self.features = tuple(features)
        self.forest = forest
        self.threshold = threshold
        # trees * (2 * sample_size) nodes at most, a few megabytes whatever the data
        self._shared = spark.sparkContext.broadcast(forest)

    def score(self, df: DataFrame) -> Column:
        """Score column for rows of ``df``; null features count as 0."""
        shared = self._shared

        @F.pandas_udf(T.DoubleType())
        def scores(*columns: pd.Series) -> pd.Series:
            return pd.Series(shared.value.score(np.column_stack([c.to_numpy(dtype=float) for c in columns])))

        return scores(*[F.coalesce(df[f].cast("double"), F.lit(0.0)) for f in self.features])

    def transform(self, df: DataFrame, flag: str = "flag_outlier", score: str | None = None) -> DataFrame:
        """Adds the outlier flag and, if named, the score."""
        scored = df.withColumn("_score", self.score(df))
        flagged = scored.withColumn(flag, F.col("_score") > F.lit(self.threshold))
        return flagged.withColumnRenamed("_score", score) if score else flagged.drop("_score")
