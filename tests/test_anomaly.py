from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaudit.operators.anomaly import detect, flag_summary, with_text_spread
from plaudit.operators.isolation_forest import IsolationForest, grow_tree, mean_path


def test_contradicting_rating_is_flagged(reviews):
    rows = {r.review_id: r for r in detect(reviews(
        {"review_id": "ok", "review_text": "Amazing value, fast delivery and premium quality."},
        {"review_id": "bad", "customer_id": "c2", "review_text": "Terrible thing, broke at once and they ignored me."},
    )).collect()}
    assert rows["bad"].flag_mismatch and rows["bad"].is_suspicious and rows["bad"].rating_sentiment_gap == 4
    assert not rows["ok"].flag_mismatch


def test_detect_adds_seven_columns_and_keeps_rows(reviews):
    raw = reviews({}, {"review_text": None, "rating": None}, {"customer_id": None})
    result = detect(raw)
    assert result.columns == raw.columns + [
        "sentiment_stars", "rating_sentiment_gap", "flag_mismatch", "text_customer_spread", "flag_duplicate_spam",
        "flag_outlier", "is_suspicious"]
    assert result.count() == 3
    assert result.filter("is_suspicious is null").count() == 0


def test_spread_counts_distinct_owners(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, ["hot", "a", "b", None, f"own{i}"][rng.integers(5)], [None, "x", "y", "z", f"c{i}"][rng.integers(5)])
        for i in range(400)
    ] + [(1000, "only null", None), (1001, "mixed", None), (1002, "mixed", "x"), (1003, "single", "x")]
    owners = defaultdict(set)
    for _, text, owner in rows:
        owners[text].update([owner] if owner else [])
    df = spark.createDataFrame(rows, "id int, review_text string, customer_id string")
    got = {r.id: r.text_customer_spread for r in with_text_spread(df).collect()}
    assert got == {i: None if text is None else len(owners[text]) for i, text, _ in rows}


def test_hot_text_is_split_across_tasks(spark):
    """A text held by most rows: adaptive execution must split its join partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(0, 20_000, 1, 8).select(
            F.when(F.col("id") % 10 > 0, "copied").otherwise(F.concat(F.lit("t"), F.col("id") % 1500)).alias("review_text"),
            F.format_string("c%d", F.col("id")).alias("customer_id"))
        result = with_text_spread(df)
        assert result.filter("review_text = 'copied'").agg(F.min("text_customer_spread")).first()[0] == 18_000
        result.collect()
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_mean_path_and_tree():
    assert mean_path(1) == 0 and mean_path(2) == 1 and mean_path(256) == pytest.approx(10.244, abs=1e-3)
    points = np.array([[0.0, 5.0], [1.0, 5.0], [9.0, 5.0]])
    tree = grow_tree(points, np.random.default_rng(0), 8)
    assert len(tree["feature"]) == 5 and set(tree["feature"]) == {0}
    assert len(grow_tree(np.ones((10, 2)), np.random.default_rng(0), 8)["feature"]) == 1


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    rows = [(int(a), int(b)) for a, b in rng.normal(50, 4, (3000, 2))] + [(0, 100)] * 3 + [(100, 0)] * 3
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "id int, a int, b int")


def test_forest_finds_far_points_and_hits_the_share(points):
    result = IsolationForest(["a", "b"], contamination=0.05).fit(points).transform(points, score="score").collect()
    flagged = {r.id for r in result if r.flag_outlier}
    assert set(range(3000, 3006)) <= flagged
    assert 0.03 <= len(flagged) / len(result) <= 0.051
    far = min(r.score for r in result if r.id >= 3000)
    assert far > np.percentile([r.score for r in result], 99)


def test_forest_does_not_depend_on_partitions(points):
    def flags(df):
        model = IsolationForest(["a", "b"], trees=20).fit(df)
        return model.threshold, sorted(r.id for r in model.transform(df).filter("flag_outlier").collect())

    assert flags(points.repartition(2)) == flags(points.repartition(7))


def test_threshold_is_the_exact_percentile(points):
    model = IsolationForest(["a", "b"], trees=20).fit(points)
    scores = [r.score for r in model.transform(points, score="score").collect()]
    assert model.threshold == pytest.approx(np.percentile(scores, 95), abs=1e-9)


def test_one_combination_holding_a_third_of_the_rows(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") < 2000, 7).otherwise(F.col("id") % 50).cast("int").alias("a"), F.lit(1).alias("b"))
    model = IsolationForest(["a", "b"], trees=30).fit(df)
    assert model.transform(df).count() == 6000


def test_planted_rows_are_found(many_reviews, reviews):
    planted = reviews(*[
        {"review_id": f"planted{n}", "rating": 5, "review_text": f"Terrible, broke, poor and disappointed, {n}"}
        for n in range(60)])
    flagged = detect(many_reviews(2000).unionByName(planted)).cache()
    mismatch = flagged.filter(F.col("review_id").startswith("planted"))
    assert mismatch.count() == 60 and mismatch.filter(~F.col("is_suspicious")).count() == 0
    (summary,) = flag_summary(flagged).collect()
    assert summary.reviews == 2060 and 0 < summary.outlier <= 0.06 * 2060
    assert summary.suspicious_share == round(summary.suspicious / 2060, 4)


def test_no_rows(reviews):
    assert detect(reviews({}).limit(0)).count() == 0
