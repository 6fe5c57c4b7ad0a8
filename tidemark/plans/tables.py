"""Access to the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of `folder`. Its times carry no zone and are UTC, so the session is set to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def item_key() -> Column:
    """The item an event is about, from its JSON properties."""
    return F.get_json_object("props", "$.k").cast("bigint")
