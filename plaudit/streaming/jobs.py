"""Streaming queries: scored topic or files, and the serving table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plaudit.operators.keyed import first_by
from plaudit.streaming.messages import score_messages, to_messages


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as a stream of ``value`` rows."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def start_scoring(
    messages: DataFrame,
    checkpoint: str,
    sink: str = "kafka",
    options: Mapping[str, str] | None = None,
    trigger: Mapping | None = None,
    as_messages: bool = True,
) -> StreamingQuery:
    """Scores a message stream into a native sink.

    A file sink delivers exactly once. A Kafka sink delivers at least once; its messages are keyed
    by ``review_id``, so a consumer can drop repeats. ``trigger`` goes to ``DataStreamWriter.trigger``,
    for example ``{"availableNow": True}`` or ``{"processingTime": "10 seconds"}``.
    """
    scored = score_messages(messages)
    writer = (
        (to_messages(scored) if as_messages else scored)
        .writeStream.format(sink).outputMode("append")
        .options(**dict(options or {})).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_serving(
    rows: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Feeds the serving table from a stream.

    Each micro-batch becomes one ``batch_id`` partition. A repeated batch overwrites its own
    partition, so a restart neither loses nor doubles rows, and no batch rewrites older data. Rows should
    carry what orders them inside a batch, such as offset or arrival time (see ``read_serving``).
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_serving(
    spark: SparkSession, path: str, order: Sequence[str], key: str = "review_id"
) -> DataFrame:
    """The newest row per key of the serving table: of the last batch, and there the last by ``order``."""
    if not order:
        raise ValueError("name the columns that order rows inside a batch")
    stored = spark.read.parquet(path)
    newest = [F.desc("batch_id"), *[F.col(name).desc_nulls_last() for name in order]]
    rest = [name for name in stored.columns if name not in (key, "batch_id", *order)]
    return first_by(stored, [key], [*newest, *rest]).drop("batch_id")


def compact_serving(spark: SparkSession, path: str, target: str, order: Sequence[str], key: str = "review_id") -> None:
    """Writes the newest rows to a new serving table, as its batch -1; later batches of a stream go on top.

    Run it on a stopped stream, then start the stream with the same checkpoint on ``target``.
    """
    read_serving(spark, path, order, key).write.parquet(f"{target.rstrip('/')}/batch_id=-1")
