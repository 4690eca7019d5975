"""Mixing sources to target weights by a low-discrepancy schedule, with Spark SQL functions only.

A source's documents, shuffled by hash, are cut into blocks of equal word count, of a size of the source's
own: at most a ``least_blocks``-th of the source, so that small sources meet their target as closely as big
ones. Its target, in blocks, is the number of slots it gets. The unit interval is cut into one stretch per
source, as long as its share of the slots. Slot ``i`` takes the golden-ratio point ``frac((i + 1) * phi)`` and
with it a source, so that every part of the schedule holds the sources in their target shares. Slots are ranked
per source, and the slot of rank ``r`` takes block ``r mod blocks``. The few slots by which points miss a
source's number are left out or follow at the end, so that a source gets exactly its number: its words are
within one block, or one word, of the target, and no block is taken more than ``max_repeats`` times.

No source is gathered in one task: running sums go through 4,096 hash buckets per source, slot ranks
through ranges of slots. Tables per source and per (source, bucket) are aggregates, written once.

Empty texts and null texts have size 0 and are never taken in words. A null source is a source of its
own, last in the order. Repeated rows count as rows of their own. Empty tables give empty results.
Columns of the input that have the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.llm.common import fresh
from plaudit.storage import materialise

GOLDEN = 0.6180339887498949
BUCKET_BITS = 12
CELLS = 1 << 16
SLOT_RANGE = 1 << 16


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(
    sources: DataFrame, weights: Sequence[int], max_repeats: int, block_words: int, least_blocks: int,
) -> DataFrame:
    """Adds to ``source, source_size``: ``target``, words of a ``block``, number of ``blocks`` and ``slots``, and
    the stretch ``low`` to ``high`` of the unit interval.

    One row per source. Weighted shares of all sizes, but ``max_repeats`` times a source's size at most;
    what that cuts off is shared anew. With sources in the order of cap over weight, the level at which
    uncapped sources stand is the largest of (what caps before leave) / (weights from here on).
    """
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    choice = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sources
        .withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(choice, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
        .withColumn("total", F.sum("source_size").over(everything)))
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    shared = (
        ranked
        .withColumn("level", level)
        .withColumn("target", F.least(F.col("cap"), F.max("level").over(everything) * F.col("weight"))))
    size = F.col("source_size")
    rounds = F.coalesce(F.floor(F.col("target") / F.nullif(size, F.lit(0))), F.lit(0))
    rest = F.round((F.col("target") - F.col("rounds") * size) / F.col("block")).cast("long")
    running = by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        shared
        .withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(size / least_blocks))))
        .withColumn("blocks", F.ceil(size / F.col("block")))
        .withColumn("rounds", rounds)
        .withColumn("slots", F.col("rounds") * F.col("blocks") + F.least(F.col("blocks"), rest))
        .withColumn("high", F.sum("slots").over(running) / F.nullif(F.sum("slots").over(everything), F.lit(0)))
        .withColumn("low", F.coalesce(F.lag("high").over(by_name), F.lit(0.0)))
        .select("key", "source", "source_size", "target", "block", "blocks", "slots", "low", "high"))


def ranked_slots(sources: DataFrame) -> DataFrame:
    """``key, slot, rank``: as many slots of a source as it is due, in the order of the schedule, ranked from 0."""
    spark = sources.sparkSession
    slots = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    stretches = sources.filter(F.col("high") > F.col("low")).select("key", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS))).alias("cell"))
    points = (
        spark.range(slots)
        .withColumn("point", ((F.col("id") + 1) * F.lit(GOLDEN)) % F.lit(1.0))
        .withColumn("cell", F.floor(F.col("point") * CELLS)))
    dealt = (
        points.join(stretches, "cell")
        .filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
        .select("key", "id", F.floor(F.col("id") / SLOT_RANGE).alias("part")))
    many = materialise(dealt.groupBy("key", "part").agg(F.count(F.lit(1)).alias("many")), "mix-slots")
    earlier = many.select("key", "part", F.coalesce(F.sum("many").over(
        Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("earlier"))
    place = F.row_number().over(Window.partitionBy("key", "part").orderBy("id"))
    due = sources.select("key", F.col("slots").alias("due"))
    by_point = (
        dealt.withColumn("place", place).join(earlier, ["key", "part"]).join(due, "key")
        .select("key", F.col("id").alias("slot"), (F.col("earlier") + F.col("place") - 1).alias("rank"), "due")
        .filter("rank < due").drop("due"))
    got = many.groupBy("key").agg(F.sum("many").alias("got"))
    missed = (
        due.join(got, "key", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < due")
        .select("key", F.explode(F.sequence("got", F.col("due") - 1)).alias("rank")))
    return by_point.unionByName(missed.select("key", (F.lit(slots) + F.col("rank")).alias("slot"), "rank"))


@dataclass(frozen=True)
class Mix:
    """``placed``: the documents with their word interval in the shuffled source and the words of its blocks;
    ``times``: how often each block of a source is taken. ``names`` has the columns added."""

    placed: DataFrame
    times: DataFrame
    names: dict[str, str]


def plan_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = (1, 2, 3),
    max_repeats: int = 3,
    block_words: int = 8192,
    least_blocks: int = 1 << 12,
    seed: int = 17,
) -> Mix:
    """Deals the sources' blocks to slots.

    A source's blocks have ``block_words`` words, or fewer where that would make fewer than ``least_blocks`` of them.
    """
    names = {n: fresh(docs, f"mix_{n}") for n in ("key", "size", "draw", "bucket", "place", "start", "block")}
    key, size, draw, bucket = (names[n] for n in ("key", "size", "draw", "bucket"))
    marked = (
        docs
        # A key that is never null: "" for the null source.
        .withColumn(key, F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source))))
        .withColumn(size, word_count(F.col(text)))
        .withColumn(draw, F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)))
        .withColumn(bucket, F.shiftrightunsigned(F.col(draw), 64 - BUCKET_BITS)))
    parts = materialise(
        marked.groupBy(F.col(key).alias("key"), F.col(source).alias("source"), F.col(bucket).alias("bucket"))
        .agg(F.sum(size).alias("words")), "mix-parts")
    sources = materialise(targets(
        parts.groupBy("key", "source").agg(F.sum("words").alias("source_size")),
        weights, max_repeats, block_words, least_blocks), "mix-sources")
    times = (
        ranked_slots(sources).join(sources.select("key", "blocks"), "key")
        .groupBy("key", (F.col("rank") % F.col("blocks")).alias("block"))
        .agg(F.count(F.lit(1)).alias("times")))
    offset = F.coalesce(F.sum("words").over(
        Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = (
        parts.select("key", "bucket", offset.alias("offset"))
        .join(sources.select("key", "source_size", "target", "block"), "key")
        .select(F.col("key").alias(key), F.col("bucket").alias(bucket), "offset", F.col("block").alias(names["block"]),
                F.col("source_size").alias("new_source_size"), F.col("target").alias("new_target")))
    inside = Window.partitionBy(key, bucket).orderBy(F.col(draw), F.col(doc_id), F.col(size))
    placed = (
        marked.join(offsets, [key, bucket])
        .withColumn(names["place"], F.row_number().over(inside))
        .withColumn(names["start"], F.col("offset") - F.col(size) + F.sum(size).over(
            inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .drop("offset"))
    return Mix(placed, times, names)


def taken_words(mix: Mix, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``size, source_size, target, taken`` of every document, by the blocks its words lie in."""
    n = mix.names
    start, size, block = F.col(n["start"]), F.col(n["size"]), F.col(n["block"])
    first, last = F.floor(start / block), F.floor((start + size - 1) / block)
    row = [n["key"], n["bucket"], n["place"]]
    columns = [c for c in keep if c not in ("size", "source_size", "target", "taken")]
    pieces = (
        mix.placed
        .withColumn("piece", F.explode_outer(F.when(size > 0, F.sequence(first, last))))
        .withColumn("piece_words", F.least(start + size, (F.col("piece") + 1) * block)
                    - F.greatest(start, F.col("piece") * block)))
    times = mix.times.select(F.col("key").alias(n["key"]), F.col("block").alias("piece"), "times")
    return (
        pieces.join(times, [n["key"], "piece"], "left")
        .groupBy(*row, *columns, size.alias("size"), F.col("new_source_size").alias("source_size"),
                 F.col("new_target").alias("target"))
        .agg(F.coalesce(F.sum(F.col("piece_words") * F.col("times")), F.lit(0)).cast("long").alias("taken"))
        .select(*columns, "size", "source_size", "target", "taken"))


def repeat_documents(mix: Mix, columns: Sequence[str]) -> DataFrame:
    """Whole documents, each as often as the block is taken that it starts in; one without words stays once."""
    n = mix.names
    times = mix.times.select(F.col("key").alias(n["key"]), F.col("block").alias("piece"), "times")
    copies = F.when(F.col(n["size"]) == 0, 1).otherwise(F.coalesce(F.col("times"), F.lit(0)).cast("int"))
    return (
        mix.placed.withColumn("piece", F.floor(F.col(n["start"]) / F.col(n["block"])))
        .join(times, [n["key"], "piece"], "left")
        .withColumn("piece", F.explode(F.array_repeat(F.lit(0), copies)))
        .select(*columns))
