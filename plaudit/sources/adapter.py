"""Reviews derived from the order tables.

There is no review table among the inputs; line items stand in for reviews. The view is dirty on
purpose: null ids, null and short texts, ratings 0 and 6, unreadable dates, repeated ids, padded
whitespace. The text runs unchanged in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.storage import balanced

RAW_REVIEWS_SQL = """
SELECT
  CASE WHEN l_orderkey % 211 = 0 AND l_linenumber = 1 THEN NULL
       ELSE 'r_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) END AS review_id,
  'p_' || CAST(l_partkey AS STRING) AS product_id,
  p_name AS product_name,
  p_type AS category,
  'cust_' || CAST(o_custkey AS STRING) AS customer_id,
  CAST(CAST(l_quantity AS INT) % 7 AS INT) AS rating,
  CASE (l_orderkey * 7 + l_linenumber * 13) % 11
    WHEN 0 THEN 'Great value, love it!'
    WHEN 1 THEN 'Quick and easy setup.'
    WHEN 2 THEN 'I recommend this to friends'
    WHEN 3 THEN 'It does the job'
    WHEN 4 THEN 'Arrived late'
    WHEN 5 THEN 'Poor finish, broke at once.'
    WHEN 6 THEN 'Never   again, terrible   seller!'
    WHEN 7 THEN 'Happy with the fast   reply, though expensive'
    WHEN 8 THEN '  ok '
    WHEN 9 THEN NULL
    ELSE 'GREAT great Great.' END
  || CASE WHEN l_linenumber % 2 = 0 OR (l_orderkey * 7 + l_linenumber * 13) % 11 = 8 THEN ''
          ELSE ' ref' || CAST(l_orderkey * 10 + l_linenumber AS STRING) END AS review_text,
  CASE l_partkey % 6 WHEN 0 THEN 'product_quality' WHEN 1 THEN 'shipping' WHEN 2 THEN 'price'
    WHEN 3 THEN 'packaging' WHEN 4 THEN 'customer_service' ELSE 'return' END AS topic,
  CASE WHEN l_orderkey % 101 = 0 THEN 'not-a-date'
       ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS review_date
FROM {lineitem}
JOIN {orders} ON o_orderkey = l_orderkey
JOIN {part} ON p_partkey = l_partkey
"""

AS_OF = "2001-01-01"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def raw_reviews(spark: SparkSession, directory: str) -> DataFrame:
    """Raw reviews, the nine columns of ``schemas.RAW_REVIEW``."""
    return spark.sql(
        RAW_REVIEWS_SQL,
        lineitem=balanced(table(spark, directory, "lineitem")),
        orders=table(spark, directory, "orders"),
        part=table(spark, directory, "part"),
    )


def as_of():
    """The day after which adapter reviews count as future."""
    return F.lit(AS_OF).cast("date")
