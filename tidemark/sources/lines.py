"""Text line sources: files, text columns, sockets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row `value` per line of the text files at `path`."""
    return spark.read.text(path, lineSep="\n").select(_without_cr("value"))


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The lines of text files as they appear in a folder."""
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(_without_cr("value"))


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket. Not replayable after a failure: use it for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def explode_lines(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per line of a text column, numbered from 0, with the `keep` columns."""
    return df.select(*keep, F.posexplode(text.lines(F.col(column))).alias("line_no", "value"))


def split_records(lines: DataFrame, separator: str = "\r\n") -> DataFrame:
    """Split lines further where they still hold a record separator."""
    return lines.withColumn("value", F.explode(text.tokens(F.col("value"), separator)))


def without_blank(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.where(~text.is_blank(F.col(column)))


def _without_cr(column: str) -> Column:
    value = F.col(column)
    return F.when(value.endswith("\r"), F.left(value, F.length(value) - 1)).otherwise(value).alias(column)
