from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from plaudit.operators.clean import clean_reviews
from plaudit.operators.keyed import first_by, global_rank, insert_ignore, number_new, upsert
from plaudit.operators.sample import fixed_sample


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters(reviews):
    raw = reviews(
        {"review_id": "ok", "review_text": "  a\t\n b  "},
        {"review_id": None}, {"review_id": "n1", "review_text": None}, {"review_id": "n2", "review_text": " ab "},
        {"review_id": "n3", "rating": 0}, {"review_id": "n4", "rating": 6}, {"review_id": "n5", "rating": None},
        {"review_id": "n6", "review_date": "soon"}, {"review_id": "n7", "review_date": "2999-01-01"},
        {"review_id": "n8", "review_date": None},
    )
    (row,) = clean_reviews(raw).collect()
    assert (row.review_id, row.review_text, row.review_length, row.word_count) == ("ok", "a b", 3, 2)
    assert (row.review_date, row.review_year, row.review_month) == (date(2024, 1, 1), 2024, 1)


def test_first_of_repeated_ids_is_repeatable(reviews):
    raw = reviews({"review_date": "2024-03-01"}, {"review_date": "2024-02-01", "rating": 4}, {"review_date": "2024-02-01"})
    assert [r.rating for r in clean_reviews(raw).collect()] == [4]
    assert [r.rating for r in clean_reviews(raw.repartition(3)).collect()] == [4]


def test_as_of(reviews):
    raw = reviews({"review_date": "2024-01-02"})
    assert clean_reviews(raw, F.lit("2024-01-01").cast("date")).count() == 0


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    first = first_by(df, ["k"], ["id"])
    text = plan(first)
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning"), text
    assert first.filter("k = 0").first()["id"] == 0 and first.count() == 667


def test_insert_ignore_keeps_known_and_first(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "z"), (2, "y")], "k int, v string")
    assert sorted(insert_ignore(old, new, ["k"], ["v"]).collect()) == [(1, "a"), (2, "y")]


def test_upsert_replaces_only_named_columns(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("c", None, 3)], "k string, seen int, n int")
    new = spark.createDataFrame([("b", 9, 9), ("c", 9, 9), ("d", 4, 4)], "k string, seen int, n int")
    assert sorted(upsert(old, new, "k", ["n"]).collect()) == [("a", 1, 1), ("b", 2, 9), ("c", None, 9), ("d", 4, 4)]


def test_global_rank_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names = spark.range(5000).select(F.format_string("n%05d", (F.col("id") * 7919) % 3000).alias("name"))
        ranked = global_rank(names, "name").orderBy("rank").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["rank"] for r in ranked] == list(range(1, 3001))
    assert [r["name"] for r in ranked] == [f"n{i:05d}" for i in range(3000)]


def test_numbers_go_on_after_the_highest(spark):
    old = spark.createDataFrame([(7, "m")], "id int, name string")
    names = spark.createDataFrame([("z",), ("m",), ("a",), ("a",), (None,)], "name string")
    assert sorted(number_new(old, names, "id", "name").collect()) == [(7, "m"), (8, "a"), (9, "z")]


def test_fixed_sample(spark):
    df = spark.range(20_000).select(F.format_string("r%d", "id").alias("k"))
    one = {r.k for r in fixed_sample(df.coalesce(1), 300, "k").collect()}
    two = {r.k for r in fixed_sample(df.repartition(9), 300, "k").collect()}
    assert len(one) == 300 and one == two
    assert one != {r.k for r in fixed_sample(df, 300, "k", seed=1).collect()}
    assert fixed_sample(df.limit(10), 300, "k").count() == 10


def test_fixed_sample_is_whole_when_one_key_dominates(spark):
    df = spark.range(9000).select(F.lit("same").alias("k"), "id")
    assert fixed_sample(df, 100, "k").count() == 100
