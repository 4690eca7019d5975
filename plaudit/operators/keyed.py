"""Operators on keyed tables: first row per key, insert-ignore, upsert, surrogate numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaudit.storage import materialise


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row per key. ``order`` should be total, then the result is repeatable.

    The planner limits each key to one row inside every map task before the shuffle, so a key
    that holds a third of all rows sends one row per task, not all of them to one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence
) -> DataFrame:
    """``existing`` plus the first incoming row of every key it lacks."""
    return existing.unionByName(new_rows(existing, incoming, keys, order))


def new_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The rows :func:`insert_ignore` would add."""
    return first_by(incoming, keys, order).join(existing.select(*keys), list(keys), "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, key: str, replace: Sequence[str]) -> DataFrame:
    """Full outer merge of two tables that are unique on ``key``.

    On a conflict the columns in ``replace`` come from ``incoming`` and all others stay.
    """
    old = existing.withColumn("_old", F.lit(True)).alias("old")
    new = incoming.withColumn("_new", F.lit(True)).alias("new")
    merged = old.join(new, key, "full_outer")

    def column(name: str):
        if name == key:
            return F.col(key)
        first, second, marker = ("new", "old", "_new") if name in replace else ("old", "new", "_old")
        kept = F.when(F.col(marker), F.col(f"{first}.{name}")).otherwise(F.col(f"{second}.{name}"))
        return kept.cast(existing.schema[name].dataType).alias(name)

    return merged.select(*[column(name) for name in existing.columns])


def global_rank(names: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` with their position (from 1) in sorted order, as ``rank``.

    Every range partition is ranked by itself and shifted by the sizes of those before it, so no
    task sees all values. The partitioned values are written first: the numbers must not depend on
    where the ranges fall when a task is run again.
    """
    ranged = materialise(
        names.select(column).dropna().distinct()
        .repartitionByRange(column).withColumn("_part", F.spark_partition_id()),
        "ranked-names",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(column)
    return (
        ranged.withColumn("_row", F.row_number().over(inside))
        .join(offsets, "_part")
        .select(column, (F.col("_offset") + F.col("_row")).alias("rank"))
    )


def number_new(existing: DataFrame, names: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """``existing`` plus unseen names, numbered on from the highest id in name order, written out.

    The result is a small written table, so later lookups know its size.
    """
    unseen = names.select(name_column).join(existing.select(name_column), name_column, "left_anti")
    top = existing.agg(F.max(id_column)).first()[0] or 0
    added = global_rank(unseen, name_column).select(
        (F.col("rank") + F.lit(top)).cast("int").alias(id_column), name_column)
    return materialise(existing.unionByName(added), "numbered")
