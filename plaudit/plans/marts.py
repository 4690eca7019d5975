"""Gold marts over Silver reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _count_and_rating() -> list:
    return [F.count(F.lit(1)).alias("review_count"), F.round(F.avg("rating"), 3).alias("avg_rating")]


def daily_category_sentiment(silver: DataFrame) -> DataFrame:
    return silver.groupBy("review_date", "category").agg(
        *_count_and_rating(), F.round(F.avg("review_length"), 1).alias("avg_review_length"))


def product_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("product_id", "product_name", "category").agg(
        *_count_and_rating(),
        F.min("review_date").alias("first_review"),
        F.max("review_date").alias("last_review"),
    )


def topic_distribution(silver: DataFrame) -> DataFrame:
    return silver.groupBy("category", "topic").agg(*_count_and_rating())


# Mart name to its query; daily rows are sorted on writing, as consumers plot them in order.
GOLD_MARTS = {
    "daily_category_sentiment": lambda silver: daily_category_sentiment(silver).orderBy("review_date", "category"),
    "product_summary": product_summary,
    "topic_distribution": topic_distribution,
}
