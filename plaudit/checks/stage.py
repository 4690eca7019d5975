"""Review lake and warehouse for the registered queries, built from a directory of order tables.

Bronze, Silver and the star schema are built once per session and directory by the library's own
jobs, as in production, where queries read stored layers and do not rebuild them.
"""

from __future__ import annotations

import threading
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from plaudit.plans.lake_jobs import bronze_to_silver
from plaudit.plans.warehouse import Star, load_warehouse, read_star, rule_flagged
from plaudit.sources.adapter import as_of, raw_reviews
from plaudit.sources.lake import Lake, land, read_bronze, read_silver
from plaudit.storage import work_path

_done: dict[tuple, object] = {}
_lock = threading.RLock()


def once(build):
    """Runs ``build(spark, directory)`` once per session and directory."""

    @wraps(build)
    def wrapper(spark: SparkSession, directory: str):
        key = (spark.sparkContext.applicationId, directory, build.__name__)
        with _lock:
            if key not in _done:
                _done[key] = build(spark, directory)
            return _done[key]

    return wrapper


@once
def _lake(spark: SparkSession, directory: str) -> Lake:
    return Lake(work_path(spark, "lake"))


@once
def build_bronze(spark: SparkSession, directory: str) -> Lake:
    lake = _lake(spark, directory)
    land(raw_reviews(spark, directory), lake)
    return lake


@once
def build_silver(spark: SparkSession, directory: str) -> Lake:
    lake = build_bronze(spark, directory)
    bronze_to_silver(spark, lake, as_of())
    return lake


@once
def build_warehouse(spark: SparkSession, directory: str) -> str:
    root = work_path(spark, "warehouse")
    load_warehouse(silver(spark, directory), root, "load-1", flag=rule_flagged)
    return root


def raw(spark: SparkSession, directory: str) -> DataFrame:
    return read_bronze(spark, build_bronze(spark, directory)).drop("ingest_date")


def silver(spark: SparkSession, directory: str) -> DataFrame:
    return read_silver(spark, build_silver(spark, directory))


def star(spark: SparkSession, directory: str) -> Star:
    return read_star(spark, build_warehouse(spark, directory))
