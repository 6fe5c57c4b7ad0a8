"""The end of a bounded stream.

A stream puts out what its watermark has passed. When its input has ended, windows still open and events
still waiting are left in the state of its last batch. They are read back from the checkpoint with
Spark's state reader and finished as tables, by the batch operators: what the stream put out and what
is finished here are together what the batch operators give. After that the checkpoint is at its end:
a stream that goes on from it would count the finished windows again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import gating as batch_gating
from tidemark.operators import patterns as batch_patterns
from tidemark.operators.aggregates import END, START, Aggregate, WindowFunction, finished, on_groups
from tidemark.sinks import streams
from tidemark.streaming.aggregates import ROWS, VALUE
from tidemark.streaming.gating import READING, SWITCH, UNTIL
from tidemark.streaming.ordered import AT, WAITING
from tidemark.streaming.patterns import FIRST

AGGREGATE, PROCESSOR = "stateStoreSave", "transformWithStateInPySparkExec"
# Before any time that rows can have; far enough from the smallest number to be cut into blocks.
EARLIEST = -(2**62)


def state(spark: SparkSession, checkpoint: str, variable: str | None = None, operator: str = AGGREGATE, place: int = 0) -> DataFrame:
    """The state as of the last batch of the `place`-th stateful `operator` of its name, in the order of their numbers."""
    found = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorName") == operator)
    numbers = sorted({row.operatorId for row in found.select("operatorId").collect()})  # operators of one query
    reader = spark.read.format("statestore").option("operatorId", numbers[place])
    if variable:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The number of the last batch whose state is in the checkpoint."""
    return spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]


def _open_windows(spark: SparkSession, checkpoint: str, keys: Sequence[str], place: int) -> DataFrame:
    """start, end, the keys and the value of every open window; the window is the first part of the state's key."""
    rows = state(spark, checkpoint, place=place)
    window, *own = [f"key.`{field.name}`" for field in rows.schema["key"].dataType.fields]
    named = [F.col(column).alias(name) for column, name in zip(own, keys, strict=True)]
    return rows.select(*named, F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), "value")


def window_counts(spark: SparkSession, checkpoint: str, keys: Sequence[str], place: int = 0) -> DataFrame:
    """The rest of `operators.windows.window_counts` as a stream."""
    rows = _open_windows(spark, checkpoint, keys, place)
    return rows.select(*keys, "window_start", "window_end", F.col("value.count").alias("view_count"))


def window_means(spark: SparkSession, checkpoint: str, keys: Sequence[str], out: str, place: int = 0) -> DataFrame:
    """The rest of `operators.windows.window_means` as a stream."""
    rows = _open_windows(spark, checkpoint, keys, place)
    return rows.select(*keys, F.col("window_end").alias("ts"), (F.col("value.sum") / F.col("value.count")).alias(out))


def _waiting(spark: SparkSession, checkpoint: str, key: str, place: int) -> DataFrame:
    """The key and the rows that were held back."""
    rows = state(spark, checkpoint, WAITING, PROCESSOR, place)
    return rows.select(F.col(f"key.{key}").alias(key), F.explode("user_map_value.rows").alias("row")).select(key, "row.*")


def decided(
    events: DataFrame, checkpoint: str, key: str, ts: str, tie: Sequence[str], within: times.Span, place: int = 0
) -> DataFrame:
    """The rest of `streaming.patterns.decided` over `events`, the stream, of which only the columns are used.

    The event that waits for its successor comes before all rows held back, and so is the first of the table that
    the batch operator decides.
    """
    spark = events.sparkSession
    first = state(spark, checkpoint, FIRST, PROCESSOR, place).select(F.col(f"key.{key}").alias(key), "value.*")
    held = first.unionByName(_waiting(spark, checkpoint, key, place)).withColumn(ts, F.timestamp_micros(AT))
    marked = held.select(*events.columns, "_first", "_second")
    after = batch_patterns.followed(marked, key, ts, tie, within)
    missed, met = F.col("next").isNull(), F.col("next._second")
    result = F.when(missed, batch_patterns.TIMEOUT).when(met, batch_patterns.SUCCESS)
    following = F.when(~missed, F.struct(*[F.col(f"next.{c}").alias(c) for c in events.columns]))
    return after.where("_first").where(missed | met).select(*events.columns, following.alias("next"), result.alias("result"))


def pairs(events: DataFrame, checkpoint: str, key: str, ts: str, tie: Sequence[str], within: times.Span, place: int = 0) -> DataFrame:
    """The rest of `streaming.patterns.pairs`."""
    found = decided(events, checkpoint, key, ts, tie, within, place)
    return found.where(F.col("result") == batch_patterns.SUCCESS).drop("result")


def sequence_or_timeout(
    events: DataFrame, checkpoint: str, key: str, ts: str, tie: Sequence[str], within: times.Span, place: int = 0
) -> DataFrame:
    """The rest of `streaming.patterns.sequence_or_timeout`."""
    return decided(events, checkpoint, key, ts, tie, within, place).drop("next")


def gated(readings: DataFrame, checkpoint: str, key: str, ts: str = "ts", place: int = 0) -> DataFrame:
    """The rest of `streaming.gating.gated` over `readings`, the stream, of which only the columns are used."""
    spark = readings.sparkSession
    held = _waiting(spark, checkpoint, key, place)
    left = held.where(F.col("_kind") == READING).withColumn(ts, F.timestamp_micros(AT)).select(*readings.columns)
    until = state(spark, checkpoint, UNTIL, PROCESSOR, place)
    ends = held.where(F.col("_kind") == SWITCH).select(key, F.col(AT).alias("_at"), "_end").unionByName(
        until.select(F.col(f"key.{key}").alias(key), F.lit(EARLIEST).alias("_at"), F.col("value.at").alias("_end"))
    )
    return batch_gating.passing(left, ends, key, ts)


def _bounded(rows: DataFrame, keys: Sequence[str], *columns: Column | str) -> DataFrame:
    """The keys and the window's bounds out of the state's key, and further columns."""
    named = [F.col(f"key.{key}").alias(key) for key in keys]
    bounds = [F.timestamp_micros(f"key.{own}").alias(name) for own, name in (("_start", START), ("_end", END))]
    return rows.select(*named, *bounds, *columns)


def aggregates(spark: SparkSession, checkpoint: str, keys: Sequence[str], aggregate: Aggregate, place: int = 0) -> DataFrame:
    """The rest of `streaming.aggregates.aggregated`."""
    left = _bounded(state(spark, checkpoint, VALUE, PROCESSOR, place), keys, "value.*")
    return finished(left, [*keys, START, END], aggregate)


def by_window(
    stream: DataFrame, checkpoint: str, keys: Sequence[str], function: WindowFunction, result: str, place: int = 0
) -> DataFrame:
    """The rest of `streaming.aggregates.by_window` over `stream`, of which only the columns are used."""
    rows = state(stream.sparkSession, checkpoint, ROWS, PROCESSOR, place)
    left = _bounded(rows, keys, "list_element")
    return on_groups(left.select(START, END, "list_element.*").select(*stream.columns, START, END), keys, function, result)


def to_end(
    stream: DataFrame, left: Callable[[], DataFrame], write: streams.Write, checkpoint: str, mode: str = "append"
) -> None:
    """Run a bounded stream over what its source holds, then hand the rest, `left`, to `write` as one more batch.

    The rest comes under the number after the last batch's, so a writer that keys its output by the number,
    such as `streams.parquet_batches`, holds every row once however often this is run.
    """
    query = streams.each_batch(stream, write, checkpoint, mode, availableNow=True)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    write(left(), last_batch(stream.sparkSession, checkpoint) + 1)
