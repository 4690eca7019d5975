"""Lexicon sentiment as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from plaudit.functions.text import UNICODE_SPACE


@dataclass(frozen=True)
class Lexicon:
    positive: tuple[str, ...]
    negative: tuple[str, ...]
    edge_marks: str = ".,!?"


# The two word lists that decide the score.
DEFAULT_LEXICON = Lexicon(
    positive=(
        "excellent", "great", "perfect", "amazing", "love", "fast", "happy",
        "worth", "helpful", "smooth", "premium", "recommend", "quick", "easy",
    ),
    negative=(
        "poor", "broke", "cheap", "late", "delayed", "overpriced", "expensive",
        "damaged", "crushed", "rude", "terrible", "nightmare", "refused",
        "scratched", "unhelpful", "ignored", "never",
    ),
)


def bare_words(text: Column, edge_marks: str) -> Column:
    """Lower-case words of a text without marks at their edges.

    A blank and the marks on both sides of it are one separator, so a single split does all the
    work and no per-word lambda runs outside generated code. The look-behind and the possessive
    repeats keep the time linear even for long runs of marks.
    """
    marks = "".join(f"\\{mark}" for mark in edge_marks)
    separator = f"(?<![{marks}])[{marks}]*+{UNICODE_SPACE}[{UNICODE_SPACE[1:-1]}{marks}]*+"
    whole = F.btrim(F.coalesce(text, F.lit("")), F.lit(edge_marks))
    return F.split(F.lower(whole), separator)


def lexicon_score(text: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Distinct positive words minus distinct negative words."""
    words = bare_words(text, lexicon.edge_marks)

    def hits(vocabulary: tuple[str, ...]) -> Column:
        return F.size(F.array_intersect(words, F.array(*[F.lit(word) for word in vocabulary])))

    return hits(lexicon.positive) - hits(lexicon.negative)


def stars_from_score(score: Column) -> Column:
    """Score -2 and less .. 2 and more onto 1..5 stars."""
    return (F.greatest(F.lit(-2), F.least(F.lit(2), score)) + F.lit(3)).cast("int")


def sentiment_stars(text: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    return stars_from_score(lexicon_score(text, lexicon))


def sentiment_label(stars: Column) -> Column:
    """Stars to label; anything outside 1, 2, 4, 5 (null included) is neutral."""
    return (
        F.when(stars.isin(1, 2), F.lit("negative"))
        .when(stars.isin(4, 5), F.lit("positive"))
        .otherwise(F.lit("neutral"))
    )
