"""Queries over the star schema: staging view, marts and headline reports.

Aggregates run on the fact by its key first and meet the dimension afterwards, so the fact is
never shuffled for a join and a hot key is one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plaudit.operators.quality import Check, Suite, validate_tables
from plaudit.plans.warehouse import Star, suspicious_column


def stg_reviews(star: Star) -> DataFrame:
    """The fact with product, category and date attributes; unmatched keys give nulls."""
    dates = star.dim_date.select(
        "date_id", F.col("full_date").alias("review_date"), F.col("year").alias("review_year"),
        F.col("month").alias("review_month"), "is_weekend")
    return (
        star.fact_reviews
        .join(star.dim_product.select("product_id", "product_name"), "product_id", "left")
        .join(star.dim_category, "category_id", "left")
        .join(dates, "date_id", "left")
        .select(
            "review_id", "product_id", "product_name", "category_name", "customer_id", "review_date",
            "review_year", "review_month", "is_weekend", "rating", "sentiment_stars", "sentiment_label",
            "review_length", "word_count", "is_suspicious")
    )


def _totals(*extra: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_n"),
        F.sum("sentiment_stars").alias("stars_sum"), F.count("sentiment_stars").alias("stars_n"),
        *extra,
    ]


def _mean(part: str) -> Column:
    """Average from partial sums; null when nothing was counted."""
    return F.round(F.try_divide(F.sum(f"{part}_sum"), F.sum(f"{part}_n")), 3)


def _ones(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def mart_category_sentiment(star: Star) -> DataFrame:
    """Per category: volume, averages, label counts; reviews without a category form a group."""
    label = F.col("sentiment_label")
    parts = star.fact_reviews.groupBy("category_id").agg(*_totals(
        _ones(label == "positive").alias("positive"),
        _ones(label == "negative").alias("negative"),
        _ones(suspicious_column()).alias("suspicious")))
    return (
        parts.join(star.dim_category, "category_id", "left")
        .groupBy("category_name")
        .agg(
            F.sum("n").alias("reviews"),
            _mean("rating").alias("avg_rating"),
            _mean("stars").alias("avg_sentiment"),
            F.sum("positive").alias("positive_reviews"),
            F.sum("negative").alias("negative_reviews"),
            F.sum("suspicious").alias("suspicious_reviews"))
        .orderBy(F.desc("reviews"), "category_name")
    )


def mart_daily_trends(star: Star) -> DataFrame:
    """Per day: volume, average rating and the mean of the last seven rows' averages.

    The window has no partition key, but its input is one row per calendar day.
    """
    parts = star.fact_reviews.groupBy("date_id").agg(*_totals())
    daily = (
        parts.join(star.dim_date.select("date_id", "full_date"), "date_id", "left")
        .groupBy(F.col("full_date").alias("review_date"))
        .agg(F.sum("n").alias("reviews"), _mean("rating").alias("avg_rating"))
    )
    week = Window.orderBy("review_date").rowsBetween(-6, Window.currentRow)
    return daily.withColumn("avg_rating_7d", F.round(F.avg("avg_rating").over(week), 3)).orderBy("review_date")


def overview(star: Star) -> DataFrame:
    """One row of headline numbers, also for an empty warehouse."""
    return star.fact_reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.round(F.avg("rating"), 3).alias("avg_rating"),
        F.round(F.avg("sentiment_stars"), 3).alias("avg_sentiment"),
        _ones(suspicious_column()).alias("suspicious_reviews"))


def by_category(star: Star) -> DataFrame:
    parts = star.fact_reviews.groupBy("category_id").agg(*_totals())
    return (
        parts.join(star.dim_category, "category_id")
        .groupBy("category_name")
        .agg(F.sum("n").alias("reviews"), _mean("rating").alias("avg_rating"), _mean("stars").alias("avg_sentiment"))
        .orderBy(F.desc("reviews"), "category_name")
    )


def daily(star: Star) -> DataFrame:
    parts = star.fact_reviews.groupBy("date_id").agg(*_totals())
    return (
        parts.join(star.dim_date.select("date_id", "full_date"), "date_id")
        .groupBy("full_date")
        .agg(F.sum("n").alias("reviews"), _mean("rating").alias("avg_rating"))
        .orderBy("full_date")
    )


def suspicious(star: Star, limit: int = 50) -> DataFrame:
    """Flagged reviews, the first ``limit`` by id."""
    return (
        star.fact_reviews.filter(F.col("is_suspicious"))
        .select("review_id", "product_id", "rating", "sentiment_stars", "sentiment_label")
        .orderBy("review_id")
        .limit(limit)
    )


def publish_models(star: Star, database: str | None = None) -> None:
    """Registers base tables and ``stg_reviews`` as views and saves both marts as tables."""
    prefix = f"{database}." if database else ""
    star.register()
    stg_reviews(star).createOrReplaceTempView("stg_reviews")
    for name, mart in (("mart_category_sentiment", mart_category_sentiment), ("mart_daily_trends", mart_daily_trends)):
        mart(star).write.mode("overwrite").saveAsTable(f"{prefix}{name}")


STARS = (1, 2, 3, 4, 5)
LABELS = ("positive", "neutral", "negative")


def _nn(column: str) -> Check:
    return Check(f"{column}_not_null", "not_null", column)


def _uq(column: str) -> Check:
    return Check(f"{column}_unique", "unique", column, allow_null=True)


def _accepted(column: str, values: tuple) -> Check:
    return Check(f"{column}_accepted", "in_set", column, values=values, allow_null=True)


# Which model carries which test.
MODEL_TESTS = {
    "fact_reviews": Suite("fact_reviews", (
        _nn("review_id"), _uq("review_id"), _nn("rating"), _accepted("rating", STARS),
        _accepted("sentiment_stars", STARS),
        Check("category_id_related", "relationship", "category_id", to="dim_category", field="category_id"))),
    "dim_category": Suite("dim_category", (_nn("category_id"), _uq("category_id"))),
    "dim_product": Suite("dim_product", (_nn("product_id"), _uq("product_id"))),
    "dim_date": Suite("dim_date", (_nn("date_id"), _uq("date_id"))),
    "stg_reviews": Suite("stg_reviews", (_nn("review_id"), _uq("review_id"), _accepted("sentiment_label", LABELS))),
    "mart_category_sentiment": Suite("mart_category_sentiment", (
        _nn("category_name"), _uq("category_name"), _nn("reviews"))),
    "mart_daily_trends": Suite("mart_daily_trends", (_nn("review_date"), _uq("review_date"))),
}


def model_tests(spark: SparkSession, star: Star) -> DataFrame:
    """All declared tests of tables, view and marts as one report."""
    tables = {
        **star.tables(),
        "stg_reviews": stg_reviews(star),
        "mart_category_sentiment": mart_category_sentiment(star),
        "mart_daily_trends": mart_daily_trends(star),
    }
    return validate_tables(spark, tables, MODEL_TESTS)
