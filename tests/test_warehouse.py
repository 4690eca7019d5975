from __future__ import annotations

import os
from datetime import date

import pytest

from plaudit.operators.clean import clean_reviews
from plaudit.operators.quality import DataQualityError
from plaudit.plans import analytics as A
from plaudit.plans import warehouse
from plaudit.plans.warehouse import (
    TABLES, Star, build_star, check_constraints, empty_star, load_warehouse, query, read_star, rule_flagged,
)


@pytest.fixture
def silver(reviews):
    return lambda *rows: clean_reviews(reviews(*rows))


def load(silver_rows, root, name):
    return load_warehouse(silver_rows, str(root), name, flag=rule_flagged)


FIRST = (
    {"review_id": "r1", "product_id": "p1", "category": "Books", "review_date": "2024-01-06", "rating": 5},
    {"review_id": "r2", "product_id": "p2", "category": "Audio", "review_date": "2024-01-07", "rating": 3,
     "customer_id": "c2", "review_text": "poor cheap late"},
)
SECOND = (
    {"review_id": "r1", "product_id": "p1", "product_name": "Renamed", "category": "Books", "review_date": "2024-01-06",
     "rating": 1},
    {"review_id": "r3", "product_id": "p3", "category": "Art", "review_date": "2024-01-08", "customer_id": "c1"},
    {"review_id": "r4", "product_id": "p3", "category": None, "review_date": "2024-01-08", "customer_id": "c1"},
)


def test_first_load(silver, tmp_path):
    star = load(silver(*FIRST), tmp_path, "load-1")
    for name, schema in TABLES.items():
        assert [(f.name, f.dataType) for f in star.tables()[name].schema] == [(f.name, f.dataType) for f in schema]
    assert sorted(star.dim_category.collect()) == [(1, "Audio"), (2, "Books")]
    assert sorted(star.dim_date.collect()) == [
        (20240106, date(2024, 1, 6), 2024, 1, 6, 6, True), (20240107, date(2024, 1, 7), 2024, 1, 7, 7, True)]
    assert sorted(star.dim_product.collect()) == [("p1", "Lamp", 2), ("p2", "Lamp", 1)]
    fact = {r.review_id: r for r in star.fact_reviews.collect()}
    assert (fact["r2"].sentiment_stars, fact["r2"].sentiment_label, fact["r2"].word_count) == (1, "negative", 3)


def test_first_load_joins_nothing(spark, silver):
    rows = silver(*FIRST)
    star = build_star(rows, rule_flagged(rows))
    assert "LeftAnti" not in star.fact_reviews._jdf.queryExecution().executedPlan().toString()


def test_second_load_adds_and_keeps(spark, silver, tmp_path):
    load(silver(*FIRST), tmp_path, "load-1")
    star = load(silver(*SECOND), tmp_path, "load-2")
    assert sorted(star.dim_category.collect()) == [(1, "Audio"), (2, "Books"), (3, "Art")]
    assert {r.product_id: (r.product_name, r.category_id) for r in star.dim_product.collect()} == {
        "p1": ("Lamp", 2), "p2": ("Lamp", 1), "p3": ("Lamp", 3)}
    assert {r.customer_id: (r.first_seen, r.review_count) for r in star.dim_customer.collect()} == {
        "c1": (date(2024, 1, 6), 3), "c2": (date(2024, 1, 7), 1)}
    facts = {r.review_id: r for r in star.fact_reviews.collect()}
    assert set(facts) == {"r1", "r2", "r3", "r4"} and facts["r1"].rating == 5 and facts["r4"].category_id is None
    # the second load stored only what was new
    assert {r.review_id for r in spark.read.parquet(str(tmp_path / "load-2" / "fact_reviews")).collect()} == {"r3", "r4"}


def test_same_load_twice_changes_nothing(silver, tmp_path):
    before = load(silver(*FIRST), tmp_path, "load-1")
    rows = {name: sorted(df.collect(), key=str) for name, df in before.tables().items()}
    after = load(silver(*FIRST), tmp_path, "load-2")
    assert {name: sorted(df.collect(), key=str) for name, df in after.tables().items()} == rows


def test_a_published_load_is_never_rewritten(silver, tmp_path):
    load(silver(*FIRST), tmp_path, "load-1")
    with pytest.raises(ValueError, match="already published"):
        load(silver(*SECOND), tmp_path, "load-1")


def test_file_times_do_not_change_the_order(spark, silver, tmp_path):
    load(silver(*FIRST), tmp_path, "load-1")
    load(silver(*SECOND), tmp_path, "load-2")
    before = {name: sorted(df.collect(), key=str) for name, df in read_star(spark, str(tmp_path)).tables().items()}
    for folder, _, names in os.walk(tmp_path / "load-1"):
        for name in names:
            os.utime(os.path.join(folder, name), (2**31, 2**31))
    os.utime(tmp_path / "_loads" / f"{1:012d}", (2**31, 2**31))
    after = {name: sorted(df.collect(), key=str) for name, df in read_star(spark, str(tmp_path)).tables().items()}
    assert before == after


def test_of_two_loads_on_one_predecessor_one_fails(spark, silver, tmp_path, monkeypatch):
    load(silver(*FIRST), tmp_path, "load-1")
    publish = warehouse._publish

    def overtaken(session, root, name, number):
        publish(session, root, "load-other", number)
        publish(session, root, name, number)

    monkeypatch.setattr(warehouse, "_publish", overtaken)
    with pytest.raises(ValueError, match="overtaken"):
        load(silver(*SECOND), tmp_path, "load-2")


def test_broken_constraint_is_not_published(spark, silver, tmp_path):
    load(silver(*FIRST), tmp_path, "load-1")
    bad = silver({"review_id": "r9", "product_id": "p9", "product_name": None})
    with pytest.raises(DataQualityError, match="dim_product.product_name_not_null"):
        load(bad, tmp_path, "load-2")
    assert os.path.exists(tmp_path / "load-2" / "dim_product")
    assert {r.review_id for r in read_star(spark, str(tmp_path)).fact_reviews.collect()} == {"r1", "r2"}
    load(silver(*SECOND), tmp_path, "load-2")  # the same name is free until it is published
    assert read_star(spark, str(tmp_path)).fact_reviews.count() == 4


def test_constraints_see_orphans_and_repeats(spark, silver):
    rows = silver(*FIRST)
    star = build_star(rows, rule_flagged(rows))
    tables = star.tables()
    tables["fact_reviews"] = star.fact_reviews.union(star.fact_reviews)
    tables["dim_product"] = star.dim_product.filter("product_id = 'p1'")
    failed = {r["name"]: r["unexpected"] for r in check_constraints(spark, Star(**tables)).collect() if not r["success"]}
    assert failed == {"fact_reviews.review_id_unique": 2, "fact_reviews.product_id_in_dim_product": 2}


def test_staging_and_marts(spark, silver, tmp_path):
    load(silver(*FIRST), tmp_path, "load-1")
    star = load(silver(*SECOND), tmp_path, "load-2")
    stg = {r.review_id: r for r in A.stg_reviews(star).collect()}
    assert len(stg) == 4 and stg["r4"].category_name is None and stg["r1"].review_date == date(2024, 1, 6)
    mart = [tuple(r) for r in A.mart_category_sentiment(star).collect()]
    assert [(m[0], m[1]) for m in mart] == [(None, 1), ("Art", 1), ("Audio", 1), ("Books", 1)]
    trend = [(r.review_date.day, r.reviews, r.avg_rating, r.avg_rating_7d) for r in A.mart_daily_trends(star).collect()]
    assert trend == [(6, 1, 5.0, 5.0), (7, 1, 3.0, 4.0), (8, 2, 5.0, 4.333)]
    assert [r.category_name for r in A.by_category(star).collect()] == ["Art", "Audio", "Books"]
    assert [r.reviews for r in A.daily(star).collect()] == [1, 1, 2]
    assert A.overview(star).first()["total_reviews"] == 4


def test_rolling_mean_counts_rows_not_days(spark):
    star = empty_star(spark)
    days = [(20240100 + d, date(2024, 1, d)) for d in range(1, 20, 2)]
    dims = spark.createDataFrame(days, "date_id int, full_date date")
    facts = spark.createDataFrame(
        [(f"r{i}", day[0], i % 5 + 1) for i, day in enumerate(days)], "review_id string, date_id int, rating short")
    wide = star.fact_reviews.drop("review_id", "date_id", "rating").columns
    from pyspark.sql import functions as F

    facts = facts.select("*", *[F.lit(None).cast(TABLES["fact_reviews"][c].dataType).alias(c) for c in wide])
    rolled = A.mart_daily_trends(Star(**{**star.tables(), "dim_date": dims, "fact_reviews": facts})).collect()
    means = [float(i % 5 + 1) for i in range(10)]
    assert [r.avg_rating_7d for r in rolled] == [
        round(sum(means[max(0, i - 6):i + 1]) / len(means[max(0, i - 6):i + 1]), 3) for i in range(10)]


def test_empty_warehouse(spark, tmp_path):
    star = read_star(spark, str(tmp_path / "nothing"))
    row = A.overview(star).first()
    assert (row.total_reviews, row.avg_rating, row.suspicious_reviews) == (0, None, None)
    assert A.by_category(star).count() == 0


def test_suspicious_limit_and_parameters(spark, silver, tmp_path):
    rows = [{"review_id": f"r{i}", "customer_id": f"c{i}"} for i in range(9)]
    star = load(silver(*rows), tmp_path, "load-1")
    assert [r.review_id for r in A.suspicious(star, 3).collect()] == ["r0", "r1", "r2"]
    star.register()
    assert query(spark, "SELECT count(*) AS n FROM fact_reviews WHERE rating = :r", {"r": 5}).first()["n"] == 9


def test_published_models_pass_their_tests(spark, silver, tmp_path):
    star = load(silver(*FIRST), tmp_path, "load-1")
    report = A.model_tests(spark, star).collect()
    assert len(report) == 20 and all(r["success"] for r in report)
    spark.sql("CREATE DATABASE IF NOT EXISTS analytics LOCATION '%s'" % (tmp_path / "db"))
    try:
        A.publish_models(star, "analytics")
        assert spark.table("analytics.mart_daily_trends").count() == 2
        assert spark.table("stg_reviews").count() == 2
    finally:
        spark.sql("DROP DATABASE analytics CASCADE")
