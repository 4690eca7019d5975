"""Suspicious reviews: rating against sentiment, repeated text, behavioural outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.functions.text import raw_word_count, text_digest
from plaudit.operators.isolation_forest import IsolationForest
from plaudit.operators.scoring import StarModel, score_sentiment
from plaudit.storage import materialise

MISMATCH_GAP = 3
SPAM_CUSTOMERS = 3
FOREST_FEATURES = ("rating", "review_length", "word_count", "rating_sentiment_gap", "text_customer_spread")


def with_mismatch(scored: DataFrame, min_gap: int = MISMATCH_GAP) -> DataFrame:
    """Adds ``rating_sentiment_gap`` and ``flag_mismatch``; needs ``sentiment_stars``."""
    gap = F.abs(F.col("rating") - F.col("sentiment_stars"))
    return scored.withColumn("rating_sentiment_gap", gap).withColumn(
        "flag_mismatch", F.coalesce(F.col("rating_sentiment_gap") >= min_gap, F.lit(False)))


def with_text_spread(
    df: DataFrame, text: str = "review_text", owner: str = "customer_id", output: str = "text_customer_spread"
) -> DataFrame:
    """Adds the number of distinct non-null owners that use exactly this text.

    Texts travel as digests. The distinct count shuffles by (text, owner) after a partial
    aggregation, so a text shared by a third of all rows is spread over the cluster. Only texts
    whose count cannot be read off a single row go into the join back: those with two owners or
    more, and those that mix null and non-null owners. The rest, usually most, need no partner.

    These counts are written out first. As a stored table they are broadcast exactly when their
    files are small; otherwise both join sides are plain shuffles, the one shape in which adaptive
    execution splits a hot partition (it cannot when a side is an aggregate still in flight).
    """
    keyed = df.withColumn("_text", text_digest(F.col(text)))
    counted = (
        keyed.filter(F.col("_text").isNotNull())
        .groupBy("_text")
        .agg(
            F.count_distinct(owner).alias("_owners"),
            F.max(F.col(owner).isNull()).alias("_some_null"),
        )
        .filter((F.col("_owners") >= 2) | ((F.col("_owners") == 1) & F.col("_some_null")))
        .select("_text", "_owners")
    )
    shared = materialise(counted, "text-owners")
    alone = F.when(F.col(owner).isNull(), 0).otherwise(1)
    spread = F.when(F.col("_text").isNotNull(), F.coalesce(F.col("_owners"), alone)).cast("long")
    return keyed.join(shared, "_text", "left").withColumn(output, spread).drop("_text", "_owners")


def with_spam(df: DataFrame, min_customers: int = SPAM_CUSTOMERS) -> DataFrame:
    """Adds ``text_customer_spread`` and ``flag_duplicate_spam``."""
    return with_text_spread(df).withColumn(
        "flag_duplicate_spam", F.coalesce(F.col("text_customer_spread") >= min_customers, F.lit(False)))


def with_rule_flags(reviews: DataFrame, load: StarModel | None = None) -> DataFrame:
    """Sentiment, mismatch and spam columns: everything that needs no fitted model."""
    return with_spam(with_mismatch(score_sentiment(reviews, load=load)))


def forest_features(flagged: DataFrame) -> DataFrame:
    return flagged.withColumns({
        "review_length": F.length("review_text"),
        "word_count": raw_word_count(F.col("review_text")),
    })


def any_flag(*flags: str) -> Column:
    suspicious = F.coalesce(F.col(flags[0]), F.lit(False))
    for flag in flags[1:]:
        suspicious = suspicious | F.coalesce(F.col(flag), F.lit(False))
    return suspicious


def detect(
    reviews: DataFrame,
    contamination: float = 0.05,
    seed: int = 42,
    trees: int = 100,
    sample_size: int = 256,
    load: StarModel | None = None,
) -> DataFrame:
    """All input rows and columns plus stars, gap, spread, three flags and ``is_suspicious``.

    Fits the outlier forest on the spot: one pass over the rule columns counts feature
    combinations, the returned DataFrame is the second pass.
    """
    ruled = with_rule_flags(reviews, load).drop("sentiment_label", "sentiment_model")
    measured = forest_features(ruled)
    forest = IsolationForest(FOREST_FEATURES, trees, sample_size, contamination, seed)
    flagged = forest.fit(measured).transform(measured, "flag_outlier")
    kept = [name for name in flagged.columns if name in ruled.columns or name == "flag_outlier"]
    return flagged.select(
        *kept, any_flag("flag_mismatch", "flag_duplicate_spam", "flag_outlier").alias("is_suspicious"))


def flag_summary(flagged: DataFrame) -> DataFrame:
    """One row: reviews scanned, suspicious ones and their share, and hits per flag."""
    suspicious = F.count_if(F.col("is_suspicious"))
    scanned = F.count(F.lit(1))
    return flagged.agg(
        scanned.alias("reviews"),
        suspicious.alias("suspicious"),
        F.round(suspicious / F.greatest(scanned, F.lit(1)), 4).alias("suspicious_share"),
        F.count_if(F.col("flag_mismatch")).alias("mismatch"),
        F.count_if(F.col("flag_duplicate_spam")).alias("duplicate_spam"),
        F.count_if(F.col("flag_outlier")).alias("outlier"),
    )
