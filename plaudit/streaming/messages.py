"""Review messages: JSON values in, keyed JSON values out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.operators.scoring import StarModel, score_sentiment
from plaudit.schemas import REVIEW_MESSAGE

SCORED_COLUMNS = ("review_id", "category", "rating", "sentiment_stars", "sentiment_label")


def parse_messages(
    messages: DataFrame, schema: T.StructType = REVIEW_MESSAGE, carry: Sequence[str] = (),
) -> DataFrame:
    """``value`` bytes or text to columns; a field that does not fit is null, extra fields are ignored.

    ``carry`` names columns of the source to keep, such as offset or arrival time.
    """
    return messages.select(
        *carry, F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*", *carry)


def unusable(messages: DataFrame) -> DataFrame:
    """Messages without a readable ``review_id``, as received, for a side sink."""
    parsed = F.from_json(F.col("value").cast("string"), REVIEW_MESSAGE)
    return messages.filter(F.coalesce(parsed["review_id"], F.lit("")) == "")


def score_messages(messages: DataFrame, load: StarModel | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Scored reviews of a batch or stream, with the columns ``carry``; one narrow stage without state."""
    parsed = parse_messages(messages, carry=carry).filter(F.col("review_id").isNotNull())
    return score_sentiment(parsed, load=load).select(*SCORED_COLUMNS, *carry)


def to_messages(df: DataFrame, key: str = "review_id") -> DataFrame:
    """``key, value`` with all columns of the row as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
