from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from plaudit.operators.quality import DataQualityError, validate
from plaudit.plans.batch import run_batch
from plaudit.plans.lake_jobs import bronze_to_silver, silver_to_gold
from plaudit.plans.warehouse import read_star, rule_flagged
from plaudit.session import s3a_options, sizing_options
from plaudit.sources.connectors import jdbc_options, kafka_sink, kafka_source
from plaudit.sources.lake import Lake, land, land_csv, read_bronze, read_csv, read_labelled, write_csv, write_report


def test_layer_paths():
    lake = Lake("s3a://lake/")
    assert lake.path("bronze", "reviews") == "s3a://lake/bronze/reviews"
    assert lake.path("silver", "/reviews/") == "s3a://lake/silver/reviews"
    assert lake.path("gold", "daily", "x") == "s3a://lake/gold/daily/x"
    assert lake.path("gold") == "s3a://lake/gold"
    with pytest.raises(KeyError):
        lake.path("platinum", "reviews")


def test_connector_options():
    assert s3a_options("store:9000", "k", "s")["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert s3a_options("store", "k", "s", secure=True)["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert kafka_source("b:1", "reviews.raw")["startingOffsets"] == "latest"
    assert kafka_source("b:1", "reviews.raw", "earliest")["subscribe"] == "reviews.raw"
    assert kafka_sink("b:1", "out")["topic"] == "out"
    assert jdbc_options("jdbc:postgresql://h/db", "u", "p")["url"].startswith("jdbc:")


def test_partitions_grow_with_the_input():
    assert sizing_options(10**6, 8)["spark.sql.shuffle.partitions"] == "8"
    assert int(sizing_options(100 * 10**12, 4000)["spark.sql.shuffle.partitions"]) == 745059


AWKWARD = [
    {"review_id": "a", "review_text": 'He said "great", twice'}, {"review_id": "b", "review_text": "two\nlines, one cell"},
    {"review_id": "c", "review_text": "  edges  "}, {"review_id": "d", "review_text": "back\\slash"},
    {"review_id": "e", "review_text": "ünï 東京", "category": None}, {"review_id": "f", "rating": None},
]


def test_csv_round_trip(spark, reviews, tmp_path):
    df = reviews(*AWKWARD)
    write_csv(df, str(tmp_path / "csv"))
    assert sorted(read_csv(spark, str(tmp_path / "csv")).collect(), key=str) == sorted(df.collect(), key=str)


def test_compressed_exports_land_in_compressed_files(spark, reviews, tmp_path):
    source, lake = str(tmp_path / "source"), Lake(str(tmp_path / "lake"))
    df = reviews(*AWKWARD)
    write_csv(df, source, "gzip")
    land_csv(spark, lake, source)
    land(df, lake)
    stored = [name for _, _, names in os.walk(lake.path("bronze", "reviews")) for name in names if name.startswith("part-")]
    assert stored and all(name.endswith(".csv.gz") for name in stored)
    rows = read_bronze(spark, lake).drop("ingest_date").collect()
    assert sorted(rows, key=str) == sorted(2 * df.collect(), key=str)


def test_landing_appends_unchanged(spark, reviews, tmp_path):
    source, lake = str(tmp_path / "source"), Lake(str(tmp_path / "lake"))
    write_csv(reviews(*AWKWARD), source)
    land_csv(spark, lake, source)
    land_csv(spark, lake, source)
    bronze = read_bronze(spark, lake)
    assert dict(bronze.dtypes)["ingest_date"] == "date"
    assert bronze.count() == 2 * len(AWKWARD)
    assert sorted(bronze.drop("ingest_date").distinct().collect(), key=str) == sorted(
        reviews(*AWKWARD).collect(), key=str)


def test_bad_cell_becomes_null(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("review_id,product_id,product_name,category,customer_id,rating,review_text,topic,review_date\n"
                    "r1,p1,Lamp,Books,c1,many,fine thing,price,2024-01-01\n")
    (row,) = read_csv(spark, str(path)).collect()
    assert row.rating is None and row.review_text == "fine thing"


def test_silver_and_gold_jobs(spark, reviews, tmp_path):
    lake = Lake(str(tmp_path))
    land(reviews({"review_id": "a"}, {"review_id": "a"}, {"review_id": "b", "category": None}, {"review_id": None}), lake)
    assert bronze_to_silver(spark, lake) == {"raw": 4, "silver": 2}
    silver = lake.read(spark, "silver", "reviews")
    assert silver.columns[-1] == "category" and {r.category for r in silver.collect()} == {"Books", None}
    assert bronze_to_silver(spark, lake) == {"raw": 4, "silver": 2}  # a rerun overwrites
    silver_to_gold(spark, lake)
    for name, rows in (("daily_category_sentiment", 2), ("product_summary", 2), ("topic_distribution", 2)):
        assert lake.read_mart(spark, name).count() == rows


def test_partition_filter_reaches_the_files(spark, reviews, tmp_path):
    lake = Lake(str(tmp_path))
    lake.write(reviews({}, {"category": "Beauty"}), "silver", "reviews", partition_by=("category",))
    plan = lake.read(spark, "silver", "reviews").filter("category = 'Books' and rating = 5").select("review_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in text and "EqualTo(rating,5)" in text


def test_labelled_texts(spark, tmp_path):
    path = tmp_path / "docs.json"
    path.write_text('{"_id": "x1", "text": "good", "label": 5}\n{"_id": {"oid": 3}, "text": "bad", "label": 1}\n')
    df = read_labelled(spark, str(path))
    assert df.dtypes == [("text", "string"), ("label", "int")] and df.count() == 2


def test_report_as_json(spark, reviews, tmp_path):
    write_report(validate(reviews({})), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).filter("success").count() == 6


def test_whole_chain(spark, many_reviews, tmp_path):
    source = str(tmp_path / "source")
    write_csv(many_reviews(618), source)
    lake, warehouse = Lake(str(tmp_path / "lake")), str(tmp_path / "warehouse")
    result = run_batch(spark, lake, source, warehouse, load="load-1")
    assert result.counts == {"raw": 618, "silver": 618}
    assert result.star.fact_reviews.count() == 618 and result.star.dim_category.count() == 5
    assert result.star.fact_reviews.filter("is_suspicious").count() > 0
    again = run_batch(spark, lake, source, warehouse, load="load-2")
    assert again.counts == {"raw": 1236, "silver": 618} and again.star.fact_reviews.count() == 618


def test_failed_gate_stops_the_chain(spark, reviews, tmp_path):
    source = str(tmp_path / "source")
    write_csv(reviews({"category": "Groceries"}), source)
    lake, warehouse = Lake(str(tmp_path / "lake")), str(tmp_path / "warehouse")
    with pytest.raises(DataQualityError, match="category_in_set"):
        run_batch(spark, lake, source, warehouse, flag=rule_flagged)
    assert not os.path.exists(lake.path("gold")) and not os.path.exists(warehouse)
    assert read_star(spark, warehouse).fact_reviews.count() == 0


def test_hot_category_fills_several_files(spark, reviews, tmp_path):
    lake = Lake(str(tmp_path))
    rows = spark.range(0, 40_000, 1, 8).select(
        F.format_string("r%d", "id").alias("review_id"), F.sha2(F.col("id").cast("string"), 512).alias("review_text"))
    raw = reviews({}).drop("review_id", "review_text").crossJoin(rows)
    land(raw, lake)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        bronze_to_silver(spark, lake)
    finally:
        if before is None:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        else:
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len([f for f in os.listdir(lake.path("silver", "reviews", "category=Books")) if f.endswith(".parquet")]) > 2


def test_nothing_valid_gives_an_empty_silver(spark, reviews, tmp_path):
    lake = Lake(str(tmp_path))
    land(reviews({"rating": 9}, {"rating": 0}), lake)
    assert bronze_to_silver(spark, lake) == {"raw": 2, "silver": 0}


def test_columns_are_landed_by_name(spark, reviews, tmp_path):
    source, lake = str(tmp_path / "source"), Lake(str(tmp_path / "lake"))
    df = reviews(*AWKWARD)
    write_csv(df.select(*reversed(df.columns)), source)
    land_csv(spark, lake, source)
    assert sorted(read_bronze(spark, lake).drop("ingest_date").collect(), key=str) == sorted(df.collect(), key=str)
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, source).collect()
