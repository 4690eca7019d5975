"""Repeatable random orders computed from keys, whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_token(seed: int, *columns: Column) -> Column:
    """32 hex digits that order rows randomly but repeatably."""
    parts = [F.coalesce(column.cast("string"), F.lit("")) for column in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
