"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(directory, f"{name}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in records), key=repr)


def difference(df, connection, sql: str) -> str | None:
    """None when equal, else a short description."""
    cursor = connection.execute(sql)
    wanted_columns = [d[0] for d in cursor.description]
    wanted = rows(wanted_columns, cursor.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(wanted_columns):
        return f"columns {sorted(df.columns)} != {sorted(wanted_columns)}"
    if len(got) != len(wanted):
        return f"rows {len(got)} != {len(wanted)}"
    for left, right in zip(got, wanted):
        if left != right:
            return f"{left} != {right}"
    return None
