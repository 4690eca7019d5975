from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plaudit.operators.quality import (
    REVIEWS_SUITE, Check, DataQualityError, Suite, gate, load_suite, summarise, validate, validate_tables,
)


def failed(df, **kwargs):
    return {r["name"] for r in validate(df, **kwargs).collect() if not r["success"]}


@pytest.fixture
def clean(reviews):
    def make(first=None, second=None):
        return reviews({"review_id": "r1", **(first or {})},
                       {"review_id": "r2", "category": "Beauty", "rating": 3, "review_text": "it is ok", **(second or {})})

    return make


def test_clean_data_passes(clean):
    report = validate(clean())
    (summary,) = summarise(report).collect()
    assert summary.success and summary.checks_passed == summary.checks_total == 6 and summary.rows == 2


def test_rating_out_of_range_fails(clean):
    assert failed(clean({"rating": 9})) == {"rating_in_range"}


def test_repeated_id_and_future_date_fail(clean):
    assert failed(clean(None, {"review_id": "r1", "review_date": "2999-01-01"})) == {
        "review_id_unique", "review_date_not_in_future"}


def test_unknown_category_fails(clean):
    assert failed(clean({"category": "Groceries"})) == {"category_in_set"}


def test_nulls_are_unexpected(reviews):
    nothing = dict.fromkeys(("review_id", "rating", "review_text", "review_date", "category"))
    report = {r["name"]: r["unexpected"] for r in validate(reviews(nothing, nothing, nothing)).collect()}
    assert report == {
        "review_id_not_null": 3, "review_id_unique": 2, "rating_in_range": 3, "review_text_min_length": 3,
        "review_date_not_in_future": 3, "category_in_set": 3}


def test_text_length_ignores_blanks_at_the_edges(clean):
    assert failed(clean({"review_text": " \t ok \n"})) == {"review_text_min_length"}


def test_between_reads_numbers_in_text_and_rejects_nan(spark):
    suite = Suite("s", (Check("in_range", "between", "v", min=0, max=10),))
    texts = spark.createDataFrame([("5",), ("x",), ("11",), (None,)], "v string")
    assert validate(texts, suite).first()["unexpected"] == 3
    numbers = spark.createDataFrame([(5.0,), (float("nan"),)], "v double")
    assert validate(numbers, suite).first()["unexpected"] == 1


def test_as_of_replaces_today(clean):
    assert failed(clean(), as_of=F.lit("2023-01-01").cast("date")) == {"review_date_not_in_future"}


def test_empty_suite_and_empty_table_pass(clean):
    empty = Suite("empty")
    assert summarise(validate(clean(), empty), empty).first()["success"]
    assert failed(clean().limit(0)) == set()


def test_unknown_type_raises():
    with pytest.raises(ValueError, match="unknown check type"):
        Check("x", "looks_nice", "rating")


def test_gate(clean):
    df = clean()
    assert gate(df) is df
    with pytest.raises(DataQualityError, match="rating_in_range"):
        gate(clean({"rating": 0}))


def test_relationships_and_null_policy(spark):
    child = spark.createDataFrame([(1,), (1,), (7,), (7,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    suite = Suite("child", (
        Check("k_unique", "unique", "k", allow_null=True),
        Check("k_in_parent", "relationship", "k", to="parent"),
        Check("k_accepted", "in_set", "k", values=(1,), allow_null=True)))
    rows = validate_tables(spark, {"child": child, "parent": parent}, {"child": suite}).collect()
    assert {r["name"]: (r["unexpected"], r["total"]) for r in rows} == {
        "child.k_unique": (2, 5), "child.k_in_parent": (2, 5), "child.k_accepted": (2, 5)}


@pytest.mark.parametrize("ending", ["yaml", "json"])
def test_suite_from_file(tmp_path, clean, ending):
    path = tmp_path / f"suite.{ending}"
    path.write_text("""{"suite": "mine", "checks": [
        {"name": "a", "type": "in_set", "column": "rating", "values": [3, 5]},
        {"name": "b", "type": "min_str_length", "column": "review_text", "min": 9}]}""")
    suite = load_suite(str(path))
    assert suite.name == "mine" and failed(clean(), suite=suite) == {"b"}


def test_default_suite_has_six_checks():
    assert [c.type for c in REVIEWS_SUITE.checks] == [
        "not_null", "unique", "between", "min_str_length", "not_future", "in_set"]
