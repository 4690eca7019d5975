"""Raw reviews to clean, unique, typed reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.functions.calendar import parse_date
from plaudit.functions.text import normalise_space, word_count
from plaudit.operators.keyed import first_by

SURVIVOR_ORDER = (
    "review_date", "product_id", "customer_id", "rating", "review_text", "product_name", "category", "topic",
)


def checked_reviews(raw: DataFrame) -> DataFrame:
    """Rows with an id, a text of three characters or more, a rating of 1..5 and a date. One narrow stage."""
    return (
        raw.filter(F.col("review_id").isNotNull() & F.col("review_text").isNotNull())
        .filter(F.col("rating").between(1, 5))
        .withColumns({
            "review_text": normalise_space(F.col("review_text")),
            "review_date": parse_date(F.col("review_date")),
        })
        .filter((F.length("review_text") >= 3) & F.col("review_date").isNotNull())
    )


def valid_reviews(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Checked rows dated up to ``as_of``, today by default."""
    newest = F.current_date() if as_of is None else as_of
    return checked_reviews(raw).filter(F.col("review_date") <= newest)


def with_derived(reviews: DataFrame) -> DataFrame:
    """Adds length, word count, year and month."""
    return reviews.withColumns({
        "review_length": F.length("review_text"),
        "word_count": word_count(F.col("review_text")),
        "review_year": F.year("review_date"),
        "review_month": F.month("review_date"),
    })


def clean_reviews(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Valid reviews, the first per ``review_id`` in a total order, with derived columns."""
    return with_derived(first_by(valid_reviews(raw, as_of), ["review_id"], SURVIVOR_ORDER))
