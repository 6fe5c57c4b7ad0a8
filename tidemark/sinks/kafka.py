"""Broker topics as line sinks. The Kafka connector must be on the session's classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def payload(df: DataFrame, value: str = "value", key: str | None = None) -> DataFrame:
    """The text columns a topic takes: `value`, and `key` where lines of one key must stay in order."""
    columns = [F.col(value).cast("string").alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*columns)


def sink_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic} | more


def publish(df: DataFrame, servers: str, topic: str, **more: str) -> None:
    """Write a table's payload to a topic."""
    df.write.format("kafka").options(**sink_options(servers, topic, **more)).save()


def publish_stream(df: DataFrame, servers: str, topic: str, checkpoint: str, **more: str) -> StreamingQuery:
    """Write a stream's payload to a topic; after a failure lines may arrive twice."""
    writer = df.writeStream.format("kafka").options(**sink_options(servers, topic, **more))
    return writer.option("checkpointLocation", checkpoint).start()
