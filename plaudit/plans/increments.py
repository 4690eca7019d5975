"""Silver and Gold kept in versions: a load reads what is new and touches what it changes.

Layout of Silver: ``silver/reviews_store/data/category=../part=../`` with the rows, ``changes/`` with the rows
each version added and removed, ``pending/`` with rows whose date lies ahead, and ``versions/`` with one
manifest per version, which names the Bronze files it has seen and the folders that hold its rows. Gold keeps
one partial aggregate per key and mart under ``gold/_store`` and brings it forward by the changes of the
versions since. What no manifest names, such as the folders of a failed load, is never read. Publishing the
manifest is the switch; readers that planned before it go on with the old folders, which stay.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.operators.clean import SURVIVOR_ORDER, checked_reviews, with_derived
from plaudit.operators.keyed import first_by
from plaudit.plans.marts import GOLD_MARTS
from plaudit.plans.warehouse import empty_table
from plaudit.schemas import RAW_REVIEW, SILVER_REVIEW
from plaudit.sources import versions
from plaudit.sources.lake import Lake, bronze_files, read_landed
from plaudit.storage import materialise, together

STORE = "reviews_store"
#: A category in more folders than this is rewritten into one when a load adds to it.
MAX_PARTS = 8

CHANGE = T.StructType([T.StructField("sign", T.IntegerType()), *SILVER_REVIEW])
_CHECKED = T.StructType([SILVER_REVIEW[f.name] if f.name == "review_date" else f for f in RAW_REVIEW])


def _silver_root(lake: Lake) -> str:
    return lake.path("silver", STORE)


def _versions(lake: Lake) -> str:
    return f"{_silver_root(lake)}/versions"


_NOTHING = {"files": [], "folders": {}, "raw": 0, "silver": 0, "pending": None, "changes": None, "predecessor": None}


def silver_version(spark: SparkSession, lake: Lake) -> tuple[int, dict] | None:
    """Number and manifest of the current version of Silver."""
    return versions.latest(spark, _versions(lake))


def _data(spark: SparkSession, lake: Lake, manifest: dict) -> DataFrame:
    """The rows of a version and, as ``_metadata``, their files."""
    root = f"{_silver_root(lake)}/data"
    paths = [f"{root}/{folder}/part={part}" for folder, parts in manifest["folders"].items() for part in parts]
    if not paths:
        return empty_table(spark, SILVER_REVIEW)
    return spark.read.schema(SILVER_REVIEW).option("basePath", root).parquet(*paths)


def read_silver_version(spark: SparkSession, lake: Lake, manifest: dict | None = None) -> DataFrame:
    """Silver as of a manifest, the current one by default; empty if there is none."""
    if manifest is None:
        manifest = (silver_version(spark, lake) or (0, _NOTHING))[1]
    return _data(spark, lake, manifest).select(*SILVER_REVIEW.names)


def _folder() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"/data/([^/]*)/part=[^/]*/[^/]*$", 1)


def _written(spark: SparkSession, lake: Lake, part: str) -> list[str]:
    """Category folders in which a part has files."""
    pattern, system = versions.files(spark, f"{_silver_root(lake)}/data/category=*/part={part}")
    return sorted(s.getPath().getParent().getName() for s in system.globStatus(pattern) or [])


def _changed(incoming: DataFrame, held: DataFrame) -> DataFrame:
    """Incoming rows that stay, sign 1, and held rows that give way to them, sign -1; both have an id once.

    Of two rows that are equal in the survivor order the held one stays.
    """
    order = lambda side: F.struct(*[F.col(f"{side}.{name}") for name in SURVIVOR_ORDER])
    row = lambda sign, side, folder: F.struct(
        F.lit(sign).alias("sign"), *[F.col(f"{side}.{name}").alias(name) for name in SILVER_REVIEW.names], folder.alias("folder"))
    pairs = incoming.alias("n").join(held.alias("h"), F.col("n.review_id") == F.col("h.review_id"), "left")
    added, removed = row(1, "n", F.lit(None).cast("string")), row(-1, "h", F.col("h.folder"))
    alone = F.col("h.review_id").isNull()
    return (
        pairs.filter(alone | (order("n") < order("h")))
        .select(F.explode(F.when(alone, F.array(added)).otherwise(F.array(added, removed))).alias("row")).select("row.*"))


@dataclass(frozen=True)
class SilverLoad:
    version: int
    manifest: dict

    @property
    def counts(self) -> dict[str, int]:
        """Raw rows read up to this version, and its rows."""
        return {"raw": self.manifest["raw"], "silver": self.manifest["silver"]}


def refresh_silver(
    spark: SparkSession, lake: Lake, as_of: Column | None = None,
    accept: Callable[[DataFrame], object] | None = None, max_parts: int = MAX_PARTS,
) -> SilverLoad:
    """Brings Silver forward by the Bronze files that no version has seen, and publishes the result.

    The same rows as a rebuild from all of Bronze: of the rows of one ``review_id`` the first in the survivor
    order stays, also if it comes with a later file. Files are added to the categories that get rows; a
    category is rewritten only if it loses a row or has ``max_parts`` folders. Rows dated after ``as_of`` wait
    for a load with a later day. ``accept`` sees the new version before it is published and stops it by
    raising; the current version then stays, and a later load starts from the same files again.
    """
    number = versions.next_number(spark, _versions(lake))
    current = silver_version(spark, lake)
    before = current[1] if current else _NOTHING
    part = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    root = _silver_root(lake)
    new_files = sorted(set(bronze_files(spark, lake)) - set(before["files"]))

    counted = F.count(F.lit(1)).alias("rows")
    raw_rows = 0
    fresh = empty_table(spark, _CHECKED)
    if new_files:
        landed = read_landed(spark, lake, [lake.path("bronze", "reviews", path) for path in new_files])
        raw_rows = landed.agg(counted).first()["rows"]
        fresh = checked_reviews(landed).select(*_CHECKED.names)
    if before["pending"]:
        fresh = fresh.unionByName(spark.read.schema(_CHECKED).parquet(f"{root}/{before['pending']}"))
    fresh = materialise(fresh, "checked")
    newest = F.current_date() if as_of is None else as_of
    ahead = fresh.filter(F.col("review_date") > newest)
    due = fresh.filter(F.col("review_date") <= newest)
    incoming = with_derived(first_by(due, ["review_id"], SURVIVOR_ORDER)).select(*SILVER_REVIEW.names)
    changed = incoming.select(F.lit(1).alias("sign"), "*", F.lit(None).cast("string").alias("folder"))
    if before["folders"]:
        # Only stored rows of the incoming ids can change. All is dealt by id once: ids, rows and their comparison.
        ids = due.select("review_id").distinct()
        held = _data(spark, lake, before).select(*SILVER_REVIEW.names, _folder().alias("folder")).join(
            ids, "review_id", "left_semi")
        changed = _changed(incoming, held)
    changes_path = f"changes/{part}"
    changed.select(*CHANGE.names, "folder").write.option("compression", "zstd").parquet(f"{root}/{changes_path}")
    changes = spark.read.schema(T.StructType([*CHANGE, T.StructField("folder", T.StringType())])).parquet(f"{root}/{changes_path}")
    added, removed = changes.filter("sign = 1"), changes.filter("sign = -1")
    sizes = changes.agg(F.count_if(F.col("sign") == 1).alias("added"), F.count_if(F.col("sign") == -1).alias("removed")).first()

    losing = {row["folder"] for row in removed.select("folder").distinct().collect()}  # one row per category
    full = {folder for folder, parts in before["folders"].items() if len(parts) >= max_parts}
    rows = added.select(*SILVER_REVIEW.names)
    rewritten = losing | full
    if rewritten:
        old = _data(spark, lake, {"folders": {f: before["folders"][f] for f in rewritten}}).select(*SILVER_REVIEW.names)
        rows = rows.unionByName(old.join(removed.select("review_id"), "review_id", "left_anti"))
    if rewritten or sizes["added"]:
        laid_out = rows.hint("rebalance", "category").withColumn("part", F.lit(part))
        laid_out.write.mode("append").option("compression", "zstd").partitionBy("category", "part").parquet(f"{root}/data")
    gained = set(_written(spark, lake, part))
    folders = {
        folder: ([] if folder in rewritten else before["folders"].get(folder, [])) + ([part] if folder in gained else [])
        for folder in sorted(gained | set(before["folders"]))}

    pending = None
    if ahead.take(1):
        pending = f"pending/{part}"
        ahead.write.parquet(f"{root}/{pending}")
    manifest = {
        "files": sorted({*before["files"], *new_files}), "folders": {f: parts for f, parts in folders.items() if parts},
        "raw": before["raw"] + raw_rows, "silver": before["silver"] + sizes["added"] - sizes["removed"],
        "pending": pending, "changes": changes_path, "predecessor": current[0] if current else None}
    if accept is not None:
        accept(read_silver_version(spark, lake, manifest))
    versions.publish(spark, _versions(lake), number, json.dumps(manifest))
    return SilverLoad(number, manifest)


# --- Gold ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PartialMart:
    """A mart as sums and extremes per key that can be merged."""

    keys: tuple[str, ...]
    sums: tuple[str, ...]
    dates: bool = False  # whether it keeps the first and the last review date

    def state(self, changes: DataFrame) -> DataFrame:
        """The partial aggregate of signed rows; ``lost`` marks keys whose extremes may be gone."""
        sign = F.col("sign").cast("long")
        columns = [F.sum(sign).alias("n"), *[F.sum(sign * F.col(c)).alias(f"sum_{c}") for c in self.sums]]
        if self.dates:
            here = F.when(F.col("sign") > 0, F.col("review_date"))
            columns += [F.min(here).alias("first"), F.max(here).alias("last"), F.max(F.col("sign") < 0).alias("lost")]
        return changes.groupBy(*self.keys).agg(*columns)

    def merged(self, parts: DataFrame) -> DataFrame:
        """Partial aggregates of one key added up; keys without rows are gone."""
        columns = [F.sum("n").alias("n"), *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in self.sums]]
        if self.dates:
            columns += [F.min("first").alias("first"), F.max("last").alias("last"), F.max("lost").alias("lost")]
        return parts.groupBy(*self.keys).agg(*columns).filter("n > 0")

    def mended(self, state: DataFrame, silver: DataFrame) -> DataFrame:
        """Extremes of keys that lost a row, found again in Silver; only the rows of those keys are grouped."""
        if not self.dates:
            return state
        # Keys may be null and have to meet nonetheless.
        same = [F.col(f"s.{key}").eqNullSafe(F.col(f"l.{key}")) for key in self.keys]
        lost = state.filter("lost")
        rows = silver.alias("s").join(lost.alias("l"), same, "left_semi").withColumn("sign", F.lit(1))
        again = self.state(rows.select(*self.keys, *self.sums, "review_date", "sign"))
        kept = state.filter(~F.col("lost"))
        return kept.unionByName(again).withColumn("lost", F.lit(False))

    def mart(self, state: DataFrame, name: str) -> DataFrame:
        mean = lambda column, digits: F.round(F.col(f"sum_{column}") / F.col("n"), digits)
        columns = [F.col("n").alias("review_count"), mean("rating", 3).alias("avg_rating")]
        if "review_length" in self.sums:
            columns.append(mean("review_length", 1).alias("avg_review_length"))
        if self.dates:
            columns += [F.col("first").alias("first_review"), F.col("last").alias("last_review")]
        rows = state.select(*self.keys, *columns)
        return rows.orderBy("review_date", "category") if name == "daily_category_sentiment" else rows


PARTIAL_MARTS = {
    "daily_category_sentiment": PartialMart(("review_date", "category"), ("rating", "review_length")),
    "product_summary": PartialMart(("product_id", "product_name", "category"), ("rating",), dates=True),
    "topic_distribution": PartialMart(("category", "topic"), ("rating",)),
}
assert set(PARTIAL_MARTS) == set(GOLD_MARTS)


def _gold_versions(lake: Lake) -> str:
    return lake.path("gold", "_store", "versions")


def _lineage(spark: SparkSession, lake: Lake, manifest: dict, until: int) -> list[dict] | None:
    """Manifests from this one back to just after version ``until``; None if that is no ancestor."""
    line = [manifest]
    while line[-1]["predecessor"] is not None and line[-1]["predecessor"] > until:
        line.append(versions.content(spark, _versions(lake), line[-1]["predecessor"]))
    return line if line[-1]["predecessor"] == until else None


def refresh_gold(spark: SparkSession, lake: Lake) -> dict[str, str]:
    """Brings the marts forward to the current Silver version and publishes all three at once.

    Reads the stored partial aggregates and the changes since, not Silver itself, but for products that lost
    a row: their dates are looked up. Without an earlier Gold version, everything is aggregated once.
    """
    current = silver_version(spark, lake)
    if current is None:
        raise ValueError("there is no version of Silver yet")
    silver_number, manifest = current
    number = versions.next_number(spark, _gold_versions(lake))
    earlier = versions.latest(spark, _gold_versions(lake))
    if earlier and earlier[1]["silver"] == silver_number:
        return earlier[1]["paths"]
    line = _lineage(spark, lake, manifest, earlier[1]["silver"]) if earlier else None
    silver = read_silver_version(spark, lake, manifest)
    if line is None:
        changes = silver.withColumn("sign", F.lit(1))
    else:
        paths = [f"{_silver_root(lake)}/{each['changes']}" for each in line]
        changes = spark.read.schema(CHANGE).parquet(*paths)

    def write(name: str, plan: PartialMart) -> tuple[str, str]:
        state = plan.state(changes)
        if line is not None:
            state = materialise(plan.merged(spark.read.parquet(earlier[1]["paths"][name]).unionByName(state)), "gold-state")
            state = plan.mended(state, silver)
        path = lake.path("gold", "_store", name, f"{number:012d}-{uuid.uuid4().hex[:8]}")
        state.write.parquet(path)
        return name, path

    written = dict(together(spark, [partial(write, name, plan) for name, plan in PARTIAL_MARTS.items()]))
    versions.publish(spark, _gold_versions(lake), number, json.dumps({"silver": silver_number, "paths": written}))
    return written


def read_gold(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A mart of the current Gold version."""
    current = versions.latest(spark, _gold_versions(lake))
    if current is None:
        raise ValueError("there is no version of Gold yet")
    return PARTIAL_MARTS[name].mart(spark.read.parquet(current[1]["paths"][name]), name)


def export_gold(spark: SparkSession, lake: Lake) -> list[str]:
    """The current marts as plain tables under their names, for consumers that read by path."""
    writes = [partial(lambda name: lake.write_mart(read_gold(spark, lake, name), name), name) for name in PARTIAL_MARTS]
    return together(spark, writes)
