"""Sentiment columns for a table of texts, by lexicon or by a user's model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.functions.sentiment import DEFAULT_LEXICON, Lexicon, sentiment_label, sentiment_stars

# Loads a model once per worker and returns a function from texts to stars.
StarModel = Callable[[], Callable[[pd.Series], pd.Series]]


def model_stars(text: Column, load: StarModel) -> Column:
    """Stars by a user's model, applied to Arrow batches; the model is loaded once per task."""

    @F.pandas_udf(T.IntegerType())
    def stars(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for batch in batches:
            yield pd.Series(predict(batch.fillna(""))).astype("int32")

    return stars(text)


def score_sentiment(
    df: DataFrame,
    text: str = "review_text",
    load: StarModel | None = None,
    model_name: str = "lexicon",
    lexicon: Lexicon = DEFAULT_LEXICON,
) -> DataFrame:
    """Adds ``sentiment_stars``, ``sentiment_label`` and ``sentiment_model``."""
    column = F.col(text)
    stars = sentiment_stars(column, lexicon) if load is None else model_stars(column, load)
    return df.withColumn("sentiment_stars", stars).withColumns({
        "sentiment_label": sentiment_label(F.col("sentiment_stars")),
        "sentiment_model": F.lit(model_name),
    })
