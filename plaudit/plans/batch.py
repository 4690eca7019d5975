"""The whole batch chain in one session."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession

from plaudit.operators.quality import REVIEWS_SUITE, Suite, gate
from plaudit.plans.increments import export_gold, read_silver_version, refresh_gold, refresh_silver
from plaudit.plans.warehouse import Star, fully_flagged, load_warehouse
from plaudit.sources.lake import Lake, land_csv


@dataclass(frozen=True)
class BatchResult:
    counts: dict[str, int]
    marts: list[str]
    star: Star


def run_batch(
    spark: SparkSession,
    lake: Lake,
    source: str,
    warehouse: str,
    suite: Suite = REVIEWS_SUITE,
    as_of: Column | None = None,
    load: str | None = None,
    flag=fully_flagged,
    multi_line: bool | None = None,
) -> BatchResult:
    """Land a CSV, bring Silver forward, gate it, then bring Gold forward and load the warehouse.

    Only files that no earlier run has seen are read. The gate sees the new version of Silver before any
    reader does: if it raises, Silver, Gold and warehouse stay as they were, and the landed files are taken
    up again by the next run. ``multi_line`` is :func:`plaudit.sources.lake.land_csv`'s.
    """
    land_csv(spark, lake, source, multi_line=multi_line)
    loaded = refresh_silver(spark, lake, as_of, accept=lambda candidate: gate(candidate, suite, as_of))
    refresh_gold(spark, lake)
    marts = export_gold(spark, lake)
    name = load or datetime.now(timezone.utc).strftime("load-%Y%m%dT%H%M%S%f")
    silver = read_silver_version(spark, lake, loaded.manifest)
    return BatchResult(loaded.counts, marts, load_warehouse(silver, warehouse, name, flag))
