"""Text expressions; all of them stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as a Unicode-aware splitter sees it (regex \s alone is ASCII in Java).
UNICODE_SPACE = r"[\s\x1C-\x1F\x85\p{Z}]"


def normalise_space(text: Column) -> Column:
    """Collapse whitespace runs to one space and trim.

    The regular expression runs only on texts that hold a run or a blank other than a space.
    """
    uneven = reduce(Column.__or__, [text.contains(mark) for mark in ("  ", "\t", "\n", "\r", "\f", "\v")])
    return F.trim(F.when(uneven, F.regexp_replace(text, r"\s+", " ")).otherwise(text))


def word_count(text: Column) -> Column:
    """Words of a normalised, non-empty text."""
    return F.size(F.split(text, r"\s+"))


def raw_word_count(text: Column) -> Column:
    """Whitespace-separated words of any text; blank and null texts have none."""
    words = F.split(F.coalesce(text, F.lit("")), f"{UNICODE_SPACE}+")
    return F.size(F.array_remove(words, ""))


def text_digest(text: Column) -> Column:
    """32-byte SHA-256 of a text: a short, collision-free stand-in for it in shuffles and joins."""
    return F.unhex(F.sha2(text, 256))
