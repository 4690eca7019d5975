"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(value: Column) -> Column:
    """Date from text, null when it cannot be read (also under ANSI mode)."""
    return value.try_cast("date")


def date_id(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def iso_weekday(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + 1


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5
