"""Broker topics as line sources. The Kafka connector must be on the session's classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(servers: str, topic: str, group: str | None = None, **more: str) -> dict[str, str]:
    """Reader options for one topic; `more` takes any further reader option."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if group:
        options["kafka.group.id"] = group
    return options | more


def stream_topic(
    spark: SparkSession, servers: str, topic: str, group: str | None = None, **more: str
) -> DataFrame:
    """The values of a topic as a stream of text lines."""
    reader = spark.readStream.format("kafka").options(**source_options(servers, topic, group, **more))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_topic(
    spark: SparkSession, servers: str, topic: str, group: str | None = None, **more: str
) -> DataFrame:
    """What a topic holds now, as a bounded table of text lines."""
    reader = spark.read.format("kafka").options(**source_options(servers, topic, group, **more))
    return reader.load().select(F.col("value").cast("string").alias("value"))
