"""Session construction and S3-compatible storage options."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it coalesces small shuffle partitions, splits hot ones
# (a category or a text may hold a third of all rows), and turns a shuffled join into a broadcast
# one only after the small side's real size is known.
BASE_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def s3a_options(endpoint: str, access_key: str, secret_key: str, secure: bool = False) -> dict[str, str]:
    """Options for an S3-compatible object store; needs the ``hadoop-aws`` jar on the cluster."""
    scheme = "https" if secure else "http"
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": f"{scheme}://{endpoint}",
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "true" if secure else "false",
    }


def sizing_options(input_bytes: int, cores: int, partition_bytes: int = 128 * 1024**2) -> dict[str, str]:
    """Shuffle and scan sizes for an input: partitions that fit in a core's memory, none idle.

    Adaptive execution merges what turns out smaller; it cannot cut a shuffle finer than this.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(cores, -(-input_bytes // partition_bytes))),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes if input_bytes < 2**40 else 4 * partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def build_session(
    app: str,
    master: str | None = None,
    storage: Mapping[str, str] | None = None,
    options: Mapping[str, str] | None = None,
) -> SparkSession:
    """UTC session with adaptive execution; later arguments override earlier ones."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_OPTIONS, **(storage or {}), **(options or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application.

    The same as ``spark-submit --py-files``, for sessions that were started without it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(), "plaudit"), "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
