"""Star schema: four dimensions and one fact, built from Silver and loaded in increments.

Layout of a warehouse: ``<root>/<load>/<table>``, and ``<root>/_loads/<number>`` with the name of each
published load. A load writes complete dimensions but only the fact rows that are new; to find those it
reads the stored fact keys. Its ``load_report`` is written after all constraints hold on the written
tables, and then it takes the number after its predecessor's; readers see numbered loads only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit import schemas
from plaudit.functions.calendar import date_id, is_weekend, iso_weekday
from plaudit.functions.sentiment import sentiment_label
from plaudit.operators.anomaly import any_flag, detect, with_rule_flags
from plaudit.operators.keyed import first_by, insert_ignore, new_rows, number_new, upsert
from plaudit.operators.quality import Check, DataQualityError, Suite, validate_tables
from plaudit.sources import versions
from plaudit.storage import together

TABLES = {
    "dim_date": schemas.DIM_DATE,
    "dim_category": schemas.DIM_CATEGORY,
    "dim_product": schemas.DIM_PRODUCT,
    "dim_customer": schemas.DIM_CUSTOMER,
    "fact_reviews": schemas.FACT_REVIEWS,
}
FACT_ORDER = ("date_id", "product_id", "customer_id", "rating", "review_length", "sentiment_stars")


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_category: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    fact_reviews: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def register(self) -> None:
        """Temporary views under the table names, for ``spark.sql``."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, and known to be so by the optimizer, which then drops joins against it."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(0).select(*columns).filter(F.lit(False))


def empty_star(spark: SparkSession) -> Star:
    return Star(**{name: empty_table(spark, schema) for name, schema in TABLES.items()})


# --- rows derived from Silver ---------------------------------------------------------------


def date_rows(silver: DataFrame) -> DataFrame:
    day = F.col("full_date")
    days = silver.select(F.col("review_date").alias("full_date")).filter(day.isNotNull()).distinct()
    return shaped(
        days.select(
            date_id(day).alias("date_id"), day, F.year(day).alias("year"), F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"), iso_weekday(day).alias("weekday"), is_weekend(day).alias("is_weekend"),
        ),
        schemas.DIM_DATE,
    )


def with_category_id(df: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Adds ``category_id`` by name, null where the name is unknown.

    ``dim_category`` is a written table, so Spark broadcasts it if, and only if, its files are small.
    """
    return df.join(dim_category.withColumnRenamed("category_name", "category"), "category", "left")


def product_rows(silver: DataFrame, dim_category: DataFrame) -> DataFrame:
    """The earliest name and category of every product."""
    named = silver.filter(F.col("product_id").isNotNull()).select(
        "product_id", "product_name", "category", "review_date", "review_id")
    first = first_by(named, ["product_id"], ["review_date", "review_id"])
    return shaped(with_category_id(first, dim_category), schemas.DIM_PRODUCT)


def customer_rows(silver: DataFrame) -> DataFrame:
    return shaped(
        silver.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
            F.min("review_date").alias("first_seen"), F.count("review_id").alias("review_count")),
        schemas.DIM_CUSTOMER,
    )


def rule_flagged(silver: DataFrame) -> DataFrame:
    """Silver with sentiment and ``is_suspicious`` from the two rules alone."""
    return with_rule_flags(silver).withColumn("is_suspicious", any_flag("flag_mismatch", "flag_duplicate_spam"))


def fully_flagged(silver: DataFrame) -> DataFrame:
    """Silver with sentiment and ``is_suspicious`` from rules and outlier forest."""
    return detect(silver).withColumn("sentiment_label", sentiment_label(F.col("sentiment_stars")))


def fact_rows(flagged: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Fact rows from flagged Silver rows with an id and a date."""
    dated = flagged.filter(F.col("review_id").isNotNull() & F.col("review_date").isNotNull())
    keyed = with_category_id(dated, dim_category).withColumn("date_id", date_id(F.col("review_date")))
    return shaped(keyed, schemas.FACT_REVIEWS)


# --- increments -----------------------------------------------------------------------------


def merge_dates(existing: DataFrame, silver: DataFrame) -> DataFrame:
    return insert_ignore(existing, date_rows(silver), ["date_id"], ["full_date"])


def merge_categories(existing: DataFrame, silver: DataFrame) -> DataFrame:
    """Known ids stay; unseen names are numbered on in name order."""
    names = silver.select(F.col("category").alias("category_name")).dropna().distinct()
    return number_new(existing, names, "category_id", "category_name")


def merge_products(existing: DataFrame, silver: DataFrame, dim_category: DataFrame) -> DataFrame:
    rows = product_rows(silver, dim_category)
    return insert_ignore(existing, rows, ["product_id"], ["product_name", "category_id"])


def merge_customers(existing: DataFrame, silver: DataFrame) -> DataFrame:
    """A known customer keeps ``first_seen`` and gets the incoming ``review_count``."""
    return upsert(existing, customer_rows(silver), "customer_id", replace=["review_count"])


def build_star(silver: DataFrame, flagged: DataFrame, existing: Star | None = None) -> Star:
    """The star after one load; ``fact_reviews`` holds existing and new rows."""
    before = existing or empty_star(silver.sparkSession)
    categories = merge_categories(before.dim_category, silver)
    return Star(
        dim_date=merge_dates(before.dim_date, silver),
        dim_category=categories,
        dim_product=merge_products(before.dim_product, silver, categories),
        dim_customer=merge_customers(before.dim_customer, silver),
        fact_reviews=insert_ignore(
            before.fact_reviews, fact_rows(flagged, categories), ["review_id"], FACT_ORDER),
    )


# --- constraints ----------------------------------------------------------------------------


def _key(column: str) -> tuple[Check, ...]:
    return (Check(f"{column}_not_null", "not_null", column), Check(f"{column}_unique", "unique", column))


def _required(*columns: str) -> tuple[Check, ...]:
    return tuple(Check(f"{c}_not_null", "not_null", c) for c in columns)


def _reference(column: str, parent: str) -> Check:
    return Check(f"{column}_in_{parent}", "relationship", column, to=parent, field=column)


def _one_to_five(column: str) -> Check:
    return Check(f"{column}_1_to_5", "between", column, min=1, max=5, allow_null=True)


CONSTRAINTS: Mapping[str, Suite] = {
    "dim_date": Suite("dim_date", (
        *_key("date_id"), *_required("full_date", "year", "month", "day", "weekday", "is_weekend"))),
    "dim_category": Suite("dim_category", (*_key("category_id"), *_key("category_name"))),
    "dim_product": Suite("dim_product", (
        *_key("product_id"), *_required("product_name"), _reference("category_id", "dim_category"))),
    "dim_customer": Suite("dim_customer", _key("customer_id")),
    "fact_reviews": Suite("fact_reviews", (
        *_key("review_id"),
        _reference("product_id", "dim_product"), _reference("customer_id", "dim_customer"),
        _reference("date_id", "dim_date"), _reference("category_id", "dim_category"),
        _one_to_five("rating"), _one_to_five("sentiment_stars"))),
}


def check_constraints(spark: SparkSession, star: Star) -> DataFrame:
    """Keys, references, required columns and ranges as one report."""
    return validate_tables(spark, star.tables(), CONSTRAINTS)


# --- stored warehouse -----------------------------------------------------------------------

LOADS = "_loads"


def _published(spark: SparkSession, root: str) -> list[str]:
    """Paths of finished loads, in the order of their numbers."""
    texts = versions.published(spark, f"{root.rstrip('/')}/{LOADS}")
    return [f"{root.rstrip('/')}/{text.strip()}" for text in texts.values()]


def _publish(spark: SparkSession, root: str, load: str, number: int) -> None:
    """Takes the number for this load. It can be taken once: of two loads on one predecessor, one fails."""
    try:
        versions.publish(spark, f"{root.rstrip('/')}/{LOADS}", number, load + "\n")
    except FileExistsError:
        raise ValueError(f"load {load!r} was overtaken by another load; run it again") from None


def read_star(spark: SparkSession, root: str) -> Star:
    """The warehouse as of the last finished load; empty if there is none."""
    return _star_of(spark, _published(spark, root))


def _star_of(spark: SparkSession, loads: list[str]) -> Star:
    if not loads:
        return empty_star(spark)
    dims = {name: spark.read.schema(schema).parquet(f"{loads[-1]}/{name}")
            for name, schema in TABLES.items() if name != "fact_reviews"}
    facts = spark.read.schema(schemas.FACT_REVIEWS).parquet(*[f"{load}/fact_reviews" for load in loads])
    return Star(**dims, fact_reviews=facts)


def load_warehouse(
    silver: DataFrame, root: str, load: str, flag=fully_flagged
) -> Star:
    """One load of Silver reviews under the name ``load``; raises before publishing if a constraint breaks.

    Dimensions are written first and read back: later joins then know their true sizes.
    """
    spark = silver.sparkSession
    number = versions.next_number(spark, f"{root.rstrip('/')}/{LOADS}")
    earlier = _published(spark, root)
    before = _star_of(spark, earlier)
    target = f"{root.rstrip('/')}/{load}"
    if load in {path.rsplit("/", 1)[-1] for path in earlier}:
        raise ValueError(f"load {load!r} is already published")

    def stored(name: str, df: DataFrame) -> DataFrame:
        shaped(df, TABLES[name]).write.mode("overwrite").parquet(f"{target}/{name}")
        return spark.read.schema(TABLES[name]).parquet(f"{target}/{name}")

    categories = stored("dim_category", merge_categories(before.dim_category, silver))

    def new_facts() -> DataFrame:
        rows = fact_rows(flag(silver), categories)
        return new_rows(before.fact_reviews, rows, ["review_id"], FACT_ORDER)

    others = {
        "dim_date": lambda: merge_dates(before.dim_date, silver),
        "dim_product": lambda: merge_products(before.dim_product, silver, categories),
        "dim_customer": lambda: merge_customers(before.dim_customer, silver),
        "fact_reviews": new_facts,
    }
    written = together(spark, [partial(lambda name, rows: stored(name, rows()), *item) for item in others.items()])
    tables = {"dim_category": categories, **dict(zip(others, written))}
    report = check_constraints(spark, Star(**tables))
    failures = report.filter(~F.col("success")).collect()
    if failures:
        raise DataQualityError(f"load {load}", failures)
    report.coalesce(1).write.mode("overwrite").json(f"{target}/load_report")
    _publish(spark, root, load, number)
    return read_star(spark, root)


def query(spark: SparkSession, sql: str, args: Mapping | None = None) -> DataFrame:
    """SQL with named parameters over the registered tables."""
    return spark.sql(sql, args=dict(args or {}))


def suspicious_column() -> Column:
    return F.coalesce(F.col("is_suspicious"), F.lit(False))
