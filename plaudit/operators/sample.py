"""Fixed-size repeatable samples and repeatable random orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.functions.draws import order_token


def fixed_sample(df: DataFrame, size: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows (all, if there are fewer), the same for the same seed and keys.

    Rows are ranked by a token made from the key; every task keeps its first ``size`` rows.
    """
    token = order_token(seed, F.col(key))
    rest = [name for name, kind in df.dtypes if name != key and not kind.startswith(("map", "struct"))]
    return df.orderBy(token, key, *rest).limit(size)


def shuffled(df: DataFrame, key: str = "review_id", seed: int = 42) -> DataFrame:
    """Rows in a repeatable random order (a distributed range sort, not a single task)."""
    return df.orderBy(order_token(seed, F.col(key)), key)
