"""Stream sinks: console, files, and per-batch work such as ranking and several outputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.functions import text
from tidemark.operators import ranking

# Fixed value: how often watermarks, and with them results, move on.
EVERY = "1 second"
# What Spark's writer leaves in a folder when all files are in place.
MARK = "_SUCCESS"

Write = Callable[[DataFrame, int], None]


def to_console(stream: DataFrame, prefix: str | None = None, mode: str = "append", **trigger: object) -> StreamingQuery:
    """Print rows; under a `prefix` each row becomes one line of its columns."""
    if prefix is not None:
        row = F.concat_ws(",", *[F.col(c).cast("string") for c in stream.columns])
        stream = stream.select(text.prefixed(row, prefix).alias("value"))
    writer = stream.writeStream.format("console").outputMode(mode).option("truncate", False)
    return _started(writer, None, trigger)


def to_parquet(stream: DataFrame, path: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Append results to Parquet files, each exactly once."""
    return _started(stream.writeStream.format("parquet").option("path", path), checkpoint, trigger)


def each_batch(stream: DataFrame, write: Write, checkpoint: str, mode: str = "append", **trigger: object) -> StreamingQuery:
    """Hand every micro-batch to `write(batch, number)`. A batch may come again under its number
    after a failure, so a writer that must not repeat itself keys its output by that number."""
    return _started(stream.writeStream.foreachBatch(write).outputMode(mode), checkpoint, trigger)


def parquet_batches(path: str) -> Write:
    """A writer that holds every row once, though a batch may come again: one folder for each batch number.

    Spark leaves a mark in a folder when all its files are there. A batch that has its mark is not written
    again; one without, cut off half-way, is written over. Read with `committed`.
    """

    def write(batch: DataFrame, number: int) -> None:
        folder = f"{path.rstrip('/')}/batch={number}"
        if not _exists(batch.sparkSession, f"{folder}/{MARK}"):
            batch.write.mode("overwrite").parquet(folder)

    return write


def committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all batches under `path` that have their mark, with the number of their `batch`."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    found = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jvm.org.apache.hadoop.fs.Path(top, f"batch=*/{MARK}"))
    folders = [status.getPath().getParent().toString() for status in found or []]
    if not folders:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("int"))
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def top_of_windows(
    counts: DataFrame, window: Sequence[str], order: Sequence[Column], n: int, write: Write, checkpoint: str, **trigger: object
) -> StreamingQuery:
    """Rank window counts as their windows close and hand on the first `n` of each window.

    In append mode a closed window comes out whole in one micro-batch, so each batch is ranked
    as a table is: no list of a window's rows is ever held in state.
    """
    return each_batch(
        counts, lambda batch, number: write(ranking.top(batch, window, order, n), number), checkpoint, **trigger
    )


def ranks_of_windows(
    counts: DataFrame, window: Sequence[str], order: Sequence[Column], write: Write, checkpoint: str,
    total: str | None = None, **trigger: object,
) -> StreamingQuery:
    """Rank window counts as their windows close and hand on all of them, with the rows of the window as `total` if named."""

    def rank(batch: DataFrame, number: int) -> None:
        batch.persist()  # placing rows samples them first
        try:
            write(ranking.numbered(batch, window, order, total=total), number)
        finally:
            batch.unpersist()

    return each_batch(counts, rank, checkpoint, **trigger)


def to_outputs(stream: DataFrame, outputs: dict[str, tuple[Column, Write]], checkpoint: str, **trigger: object) -> StreamingQuery:
    """Several outputs of one pass over a stream: each takes the rows that meet its condition.

    A batch that failed between two outputs comes again to both; writers from `parquet_batches` then keep
    every row once.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for condition, write_output in outputs.values():
                write_output(batch.where(condition), number)
        finally:
            batch.unpersist()

    return each_batch(stream, write, checkpoint, **trigger)


def _started(writer: DataStreamWriter, checkpoint: str | None, trigger: dict[str, object]) -> StreamingQuery:
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": EVERY})).start()
