"""Shared working space for intermediate tables.

Intermediate results that are read more than once are written as Parquet below the folder the
cluster names in ``spark.checkpoint.dir``. A lost executor then costs a re-read, not a re-run, and
the read-back carries file sizes, so the planner can decide about broadcasting by itself.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables; a temporary one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="plaudit-"))
    return context.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{work_root(spark)}/plaudit/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def balanced(df: DataFrame) -> DataFrame:
    """Spreads rows that come in fewer tasks than the cluster has cores; bigger inputs stay as they are.

    For small inputs with much work per row, which Spark would size by bytes alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def together(spark: SparkSession, actions: Sequence[Callable[[], Result]], at_once: int = 4) -> list[Result]:
    """Runs independent Spark actions a few at a time, so that one's tail does not idle the cluster."""
    with ThreadPool(max(1, min(at_once, len(actions)))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda action: action()), actions)
