"""Lake jobs: Bronze to Silver, Silver to Gold."""

from __future__ import annotations

from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plaudit.operators.clean import clean_reviews
from plaudit.plans.marts import GOLD_MARTS
from plaudit.sources.lake import Lake, read_bronze, read_silver
from plaudit.storage import together


def bronze_to_silver(
    spark: SparkSession, lake: Lake, as_of: Column | None = None, rebalance: bool = True
) -> dict[str, int]:
    """Rewrites Silver reviews, partitioned by category; returns raw and clean row counts.

    Both counts are observed while writing, so the input is read once. The rebalance before the
    write splits a category with a third of all rows into many files and merges small ones; without
    it every task of the de-duplication writes one file per category, which saves a shuffle and is
    the better choice when there are few categories and big tasks.
    """
    raw_seen, silver_seen = Observation("raw"), Observation("silver")
    count = F.count(F.lit(1))
    raw = read_bronze(spark, lake).drop("ingest_date")
    silver = clean_reviews(raw.observe(raw_seen, count.alias("rows")), as_of).observe(silver_seen, count.alias("rows"))
    laid_out = silver.hint("rebalance", "category") if rebalance else silver
    lake.write(laid_out, "silver", "reviews", partition_by=("category",))
    return {"raw": _rows(raw_seen, raw), "silver": _rows(silver_seen, read_silver(spark, lake))}


def _rows(seen: Observation, df: DataFrame) -> int:
    """The observed count; adaptive execution drops observations of a plan it found to be empty."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return df.count()


def silver_to_gold(spark: SparkSession, lake: Lake) -> list[str]:
    """Rewrites the three Gold marts; each scans only the Silver columns it needs."""
    silver = read_silver(spark, lake)
    writes = [partial(lambda name, mart: lake.write_mart(mart(silver), name), *item) for item in GOLD_MARTS.items()]
    return together(spark, writes)
