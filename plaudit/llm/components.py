"""Connected components of an edge table by alternating star contraction.

Every round is two joins on a node with its smallest neighbour, which is a pre-aggregated minimum; it is
written to the shared folder, so that lineage stays short. A round makes no more edges than it gets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.storage import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node but components' smallest ones.

    ``edges`` has ``a`` and ``b`` of one type; order and repetition do not matter, loops are ignored.
    """
    current = materialise(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    mark = _mark(current)
    while mark[0]:
        current = materialise(_small_star(_large_star(current)), "edges")
        after = _mark(current)
        if after == mark:
            break
        mark = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def smallest_linked(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index linked with each index."""
    root = np.arange(size)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def in_squares(grouped: DataFrame, contents: DataFrame, block: int) -> DataFrame:
    """Deals the rows of ``contents`` out so that all members of a component meet in pairs of blocks.

    ``grouped`` is a result of ``components``, ``contents`` has ``node`` and whatever the comparison needs.
    Adds ``component, block, low, high``: a component of up to ``block`` members is one square (0, 0); a
    bigger one has as many blocks as that takes, by hash, and a row goes to the square of its block with
    every block, the smaller number first.
    """
    groups = grouped.unionByName(grouped.select(F.col("component").alias("node"), "component").distinct())
    parts = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    members = groups.join(parts, "component").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    return (
        contents.join(members, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        .drop("other", "parts"))
