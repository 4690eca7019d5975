from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

TESTDATA = os.environ.get("PLAUDIT_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from plaudit.session import build_session

    session = build_session("plaudit-tests", "local[4]", options={
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    if not os.path.isdir(TESTDATA):
        pytest.skip(f"no test data at {TESTDATA}")
    return TESTDATA


@pytest.fixture
def reviews(spark):
    """Makes a raw review table from dictionaries; missing fields get plain values."""
    from plaudit.schemas import RAW_REVIEW

    plain = {
        "review_id": "r1", "product_id": "p1", "product_name": "Lamp", "category": "Books", "customer_id": "c1",
        "rating": 5, "review_text": "great book", "topic": "price", "review_date": "2024-01-01",
    }

    def make(*rows):
        return spark.createDataFrame(
            [tuple({**plain, **row}[f.name] for f in RAW_REVIEW) for row in rows], RAW_REVIEW)

    return make


@pytest.fixture(scope="session")
def many_reviews(spark):
    """Makes a clean review table of this many rows; the text says what the rating says."""
    from pyspark.sql import functions as F

    from plaudit.schemas import RAW_REVIEW

    categories = ("Electronics", "Books", "Home & Kitchen", "Fashion", "Beauty")
    said = {1: "Terrible, broke at once", 2: "Poor finish, disappointed", 4: "Great value", 5: "I love it, perfect"}

    def make(rows, first=0):
        number = F.col("id")
        rating = F.element_at(F.array(*[F.lit(r) for r in said]), (number % 4 + 1).cast("int"))
        text = F.element_at(F.array(*[F.lit(t) for t in said.values()]), (number % 4 + 1).cast("int"))
        category = F.element_at(F.array(*[F.lit(c) for c in categories]), (number % 5 + 1).cast("int"))
        return spark.range(first, first + rows).select(
            F.format_string("r%05d", number).alias("review_id"), F.format_string("p%d", number % 25).alias("product_id"),
            F.format_string("Product %d", number % 25).alias("product_name"), category.alias("category"),
            F.format_string("c%d", number % 97).alias("customer_id"), rating.cast("int").alias("rating"),
            F.concat(text, F.lit(", order "), number).alias("review_text"), F.lit("price").alias("topic"),
            F.date_add(F.lit("2024-01-01").cast("date"), (number % 300).cast("int")).cast("string").alias("review_date"),
        ).select(*RAW_REVIEW.names)

    return make
