"""The serving table behind search: one document per review, last write wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.operators.embed import VectorModel, embed
from plaudit.operators.keyed import first_by
from plaudit.operators.scoring import StarModel, score_sentiment

FIELDS = ("review_id", "review_text", "category", "rating", "sentiment_stars", "sentiment_label")


def search_documents(
    reviews: DataFrame, with_vector: bool = True, load: StarModel | None = None,
    load_vectors: VectorModel | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Scored reviews in the shape of a search document, with a vector unless left out.

    ``keep`` names further columns, such as what orders writes of one review.
    """
    documents = score_sentiment(reviews, load=load).select(*FIELDS, *keep)
    return embed(documents, load=load_vectors) if with_vector else documents


def upsert_documents(existing: DataFrame, incoming: DataFrame, order: Sequence[str]) -> DataFrame:
    """Replaces documents by ``review_id``. Several incoming ones compete: the last by ``order`` wins.

    ``order`` names columns of ``incoming`` that tell the sequence of writes (batch, offset, time); those
    that ``existing`` does not have are left out of the result. Rows equal in them rank by their content.
    """
    if not order:
        raise ValueError("name the columns that order writes")
    by = [F.col(name).desc_nulls_last() for name in (*order, *[n for n in FIELDS[1:] if n not in order])]
    latest = first_by(incoming, ["review_id"], by).drop(*[name for name in order if name not in existing.columns])
    kept = existing.join(latest.select("review_id"), "review_id", "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)
