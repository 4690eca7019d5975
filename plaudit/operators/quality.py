"""Declarative data-quality checks compiled to aggregates.

All row-level checks of a suite share one pass. Each uniqueness or reference check is one
pre-aggregated shuffle on its own column, so a hot value costs one row per map task.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.functions.calendar import parse_date

ROW_KINDS = ("not_null", "between", "min_str_length", "not_future", "in_set")
KINDS = (*ROW_KINDS, "unique", "relationship")

BLANKS = " \t\n\r\f\v"

REPORT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("column", T.StringType(), False),
    T.StructField("unexpected", T.LongType(), False),
    T.StructField("total", T.LongType(), False),
    T.StructField("success", T.BooleanType(), False),
])


class DataQualityError(RuntimeError):
    """A gate that did not pass; ``failures`` holds the failed report rows."""

    def __init__(self, suite: str, failures: Sequence):
        self.suite = suite
        self.failures = list(failures)
        listed = ", ".join(f"{row['name']} ({row['unexpected']} of {row['total']})" for row in self.failures)
        super().__init__(f"suite {suite!r} failed: {listed}")


@dataclass(frozen=True)
class Check:
    """One check. ``allow_null`` lets null pass checks other than ``not_null``."""

    name: str
    type: str
    column: str
    min: float | None = None
    max: float | None = None
    values: tuple = ()
    to: str | None = None
    field: str | None = None
    allow_null: bool = False

    def __post_init__(self):
        if self.type not in KINDS:
            raise ValueError(f"unknown check type: {self.type}")


@dataclass(frozen=True)
class Suite:
    name: str
    checks: tuple[Check, ...] = ()


# The default suite for reviews, check by check.
REVIEWS_SUITE = Suite("reviews_silver", (
    Check("review_id_not_null", "not_null", "review_id"),
    Check("review_id_unique", "unique", "review_id"),
    Check("rating_in_range", "between", "rating", min=1, max=5),
    Check("review_text_min_length", "min_str_length", "review_text", min=3),
    Check("review_date_not_in_future", "not_future", "review_date"),
    Check("category_in_set", "in_set", "category",
          values=("Electronics", "Home & Kitchen", "Books", "Fashion", "Beauty")),
))


def suite_from_mapping(spec: Mapping) -> Suite:
    """Suite from ``{"suite": name, "checks": [{"name", "type", "column", ...}]}``."""
    checks = []
    for entry in spec.get("checks") or ():
        options = dict(entry)
        options["values"] = tuple(options.get("values") or ())
        checks.append(Check(**options))
    return Suite(spec["suite"], tuple(checks))


def load_suite(path: str) -> Suite:
    """Suite from a YAML or JSON file on the driver."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        return suite_from_mapping(json.loads(text))
    import yaml  # only YAML suites need it

    return suite_from_mapping(yaml.safe_load(text))


def broken(check: Check, as_of: Column | None = None) -> Column:
    """True for a row that breaks a row-level check."""
    value = F.col(check.column)
    if check.type == "not_null":
        return value.isNull()
    if check.type == "between":
        fits = value.try_cast("double").between(check.min, check.max)
    elif check.type == "min_str_length":
        fits = F.length(F.btrim(value.cast("string"), F.lit(BLANKS))) >= check.min
    elif check.type == "not_future":
        fits = parse_date(value) <= (F.current_date() if as_of is None else as_of)
    elif check.type == "in_set":
        fits = value.isin(*check.values)
    else:
        raise ValueError(f"not a row-level check: {check.type}")
    fails = ~F.coalesce(fits, F.lit(False))
    return fails & value.isNotNull() if check.allow_null else fails


def _report_row(check: Check, unexpected: Column, total: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("name"),
        F.lit(check.type).alias("type"),
        F.lit(check.column).alias("column"),
        unexpected.cast("long").alias("unexpected"),
        total.cast("long").alias("total"),
        (unexpected == 0).alias("success"),
    )


def _row_report(df: DataFrame, checks: Sequence[Check], as_of: Column | None) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(broken(check, as_of)).alias(f"u{i}") for i, check in enumerate(checks)],
    )
    rows = [_report_row(check, F.col(f"u{i}"), F.col("total")) for i, check in enumerate(checks)]
    return counts.select(F.inline(F.array(*rows)))


def _sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def _unique_report(df: DataFrame, check: Check) -> DataFrame:
    copies = df.groupBy(F.col(check.column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    surplus = F.col("n") - 1
    if check.allow_null:
        surplus = F.when(F.col("value").isNotNull(), surplus).otherwise(0)
    counts = copies.agg(_sum(surplus).alias("unexpected"), _sum(F.col("n")).alias("total"))
    return counts.select(F.inline(F.array(_report_row(check, F.col("unexpected"), F.col("total")))))


def _relationship_report(df: DataFrame, check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    children = df.groupBy(F.col(check.column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    parents = tables[check.to].select(F.col(check.field or check.column).alias("value")).dropna().distinct()
    matched = children.join(parents.withColumn("found", F.lit(True)), "value", "left")
    orphan = F.col("found").isNull() & F.col("value").isNotNull()
    counts = matched.agg(
        _sum(F.when(orphan, F.col("n")).otherwise(0)).alias("unexpected"), _sum(F.col("n")).alias("total"))
    return counts.select(F.inline(F.array(_report_row(check, F.col("unexpected"), F.col("total")))))


def _union(parts: list[DataFrame]) -> DataFrame:
    """Union as a balanced tree; a chain would analyse its head once per further part."""
    while len(parts) > 1:
        pairs = [parts[i:i + 2] for i in range(0, len(parts), 2)]
        parts = [pair[0].union(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return parts[0]


def validate(
    df: DataFrame,
    suite: Suite = REVIEWS_SUITE,
    as_of: Column | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One report row per check; a check succeeds when nothing is unexpected."""
    parts = []
    row_checks = [check for check in suite.checks if check.type in ROW_KINDS]
    if row_checks:
        parts.append(_row_report(df, row_checks, as_of))
    for check in suite.checks:
        if check.type == "unique":
            parts.append(_unique_report(df, check))
        elif check.type == "relationship":
            parts.append(_relationship_report(df, check, tables or {}))
    if not parts:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    return _union(parts)


def summarise(report: DataFrame, suite: Suite = REVIEWS_SUITE) -> DataFrame:
    """One row: suite, rows, number of checks, number passed, overall success."""
    passed = F.count_if(F.col("success"))
    return report.agg(
        F.lit(suite.name).alias("suite"),
        F.coalesce(F.max("total"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("checks_total"),
        passed.alias("checks_passed"),
        (passed == F.count(F.lit(1))).alias("success"),
    )


def gate(
    df: DataFrame,
    suite: Suite = REVIEWS_SUITE,
    as_of: Column | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Pass ``df`` on when the suite holds, else raise :class:`DataQualityError`.

    Give it a written table: every uniqueness check reads its input again.
    """
    failures = validate(df, suite, as_of, tables).filter(~F.col("success")).collect()
    if failures:
        raise DataQualityError(suite.name, failures)
    return df


def validate_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], suites: Mapping[str, Suite]
) -> DataFrame:
    """Reports of several tables under one roof, check names prefixed with the table name."""
    reports = []
    for name, suite in suites.items():
        renamed = replace(suite, checks=tuple(replace(c, name=f"{name}.{c.name}") for c in suite.checks))
        reports.append(validate(tables[name], renamed, tables=tables))
    return _union(reports) if reports else spark.createDataFrame([], REPORT_SCHEMA)
