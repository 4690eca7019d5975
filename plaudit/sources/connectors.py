"""Options for external systems. Their jars are the cluster's business; none is bundled here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_source(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    """Options of a Kafka source; ``starting='earliest'`` replays the topic."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def kafka_sink(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "3"}


def jdbc_options(url: str, user: str, password: str, driver: str = "org.postgresql.Driver") -> dict[str, str]:
    return {"url": url, "user": user, "password": password, "driver": driver}


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Live topic as a streaming DataFrame with ``key`` and ``value``."""
    return spark.readStream.format("kafka").options(**options).load()


def publish(messages: DataFrame, options: dict[str, str]) -> None:
    """Write keyed messages (see ``streaming.messages.to_messages``) to a topic."""
    messages.write.format("kafka").options(**options).save()


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], batch_rows: int = 10_000) -> None:
    """Append to a database table in batches, one connection per partition."""
    (
        df.write.format("jdbc").options(**options)
        .option("dbtable", table).option("batchsize", batch_rows)
        .mode("append").save()
    )
