"""Row shapes of the review domain."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW_COLUMNS = (
    "review_id", "product_id", "product_name", "category", "customer_id",
    "rating", "review_text", "topic", "review_date",
)

RAW_REVIEW = T.StructType([
    T.StructField(name, T.IntegerType() if name == "rating" else T.StringType())
    for name in REVIEW_COLUMNS
])

# The partition column stands last, where a partitioned table puts it.
SILVER_REVIEW = T.StructType(
    [T.StructField("review_date", T.DateType()) if f.name == "review_date" else f
     for f in RAW_REVIEW if f.name != "category"]
    + [T.StructField(name, T.IntegerType()) for name in ("review_length", "word_count", "review_year", "review_month")]
    + [RAW_REVIEW["category"]]
)

# The four fields a live message carries; other fields in the JSON are ignored.
REVIEW_MESSAGE = T.StructType([RAW_REVIEW[name] for name in ("review_id", "category", "rating", "review_text")])

DIM_DATE = T.StructType([
    T.StructField("date_id", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.ShortType()),
    T.StructField("month", T.ShortType()),
    T.StructField("day", T.ShortType()),
    T.StructField("weekday", T.ShortType()),
    T.StructField("is_weekend", T.BooleanType()),
])

DIM_CATEGORY = T.StructType([
    T.StructField("category_id", T.IntegerType()),
    T.StructField("category_name", T.StringType()),
])

DIM_PRODUCT = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category_id", T.IntegerType()),
])

DIM_CUSTOMER = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("first_seen", T.DateType()),
    T.StructField("review_count", T.IntegerType()),
])

FACT_REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("date_id", T.IntegerType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("rating", T.ShortType()),
    T.StructField("sentiment_stars", T.ShortType()),
    T.StructField("sentiment_label", T.StringType()),
    T.StructField("review_length", T.IntegerType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("is_suspicious", T.BooleanType()),
])
