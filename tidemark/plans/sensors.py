"""Sensor averages, also by a caller's own functions, gated forwarding, lateness, and epoch conversions."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import readings, times
from tidemark.operators import aggregates, gating, lateness, windows
from tidemark.plans import tables


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.load(spark, folder, "events")
    return events.select(F.col("user_id").alias("id"), "ts", F.col("value").alias("temperature"))


def _mean(spark: SparkSession, folder: str, size: str) -> DataFrame:
    celsius = readings.celsius(F.col("temperature"))
    means = windows.window_means(_readings(spark, folder), ["id"], "ts", celsius, size, "temperature")
    return means.withColumn("temperature", F.round("temperature", 6))


def sensor_avg(spark: SparkSession, folder: str) -> DataFrame:
    return _mean(spark, folder, "1 second")


def sensor_avg_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return _mean(spark, folder, "1 hour")


def fold_mean(keys: tuple, bounds: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The mean temperature of one sensor and window, folded over its batches."""
    count, total = 0, 0.0
    for batch in batches:
        values = batch.column("temperature").drop_null()
        count, total = count + len(values), total + (pc.sum(values).as_py() or 0.0)
    yield {"temperature": [total / count if count else None]}


def sensor_avg_folded(spark: SparkSession, folder: str) -> DataFrame:
    """The mean temperature of each kind of event and hour, by a function that gets each window as a whole."""
    events = tables.load(spark, folder, "events")
    celsius = events.select("event_type", "ts", readings.celsius(F.col("value")).alias("temperature"))
    means = aggregates.by_window(celsius, ["event_type"], "ts", "1 hour", fold_mean, "temperature double")
    return means.select("event_type", F.col("window_end").alias("ts"), F.round("temperature", 6).alias("temperature"))


class GeometricMean(aggregates.Aggregate):
    """The geometric mean of the positive values of a column; null without any."""

    partial, result = "n bigint, logs double", "mean double"

    def __init__(self, column: str):
        self.column = column

    def zero(self) -> tuple:
        return 0, 0.0

    def add(self, value: tuple, rows: pa.RecordBatch) -> tuple:
        values = rows.column(self.column)
        values = values.filter(pc.greater(values, 0), null_selection_behavior="drop")
        return value[0] + len(values), value[1] + (pc.sum(pc.ln(values)).as_py() or 0.0)

    def merge(self, one: tuple, other: tuple) -> tuple:
        return one[0] + other[0], one[1] + other[1]

    def finish(self, value: tuple) -> tuple:
        return (math.exp(value[1] / value[0]) if value[0] else None,)


def geometric_means(spark: SparkSession, folder: str) -> DataFrame:
    """The geometric mean of the values of each kind of event, by an aggregate of its own."""
    events = tables.load(spark, folder, "events").select("event_type", "value")
    means = aggregates.aggregated(events, ["event_type"], GeometricMean("value"))
    return means.select("event_type", F.round("mean", 6).alias("mean"))


# Blocks of a second of arrivals, and such blocks per wider block.
ARRIVAL_WIDTHS = (1_000, 4_096, 4_096)
ARRIVAL_DELAY, ARRIVAL_SIZE, ARRIVAL_SLIDE = "30 minutes", "30 minutes", "10 minutes"


def late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive `k` minutes after their time, with the watermark then, and whether all their windows are over."""
    events = tables.load(spark, folder, "events")
    arrived = (F.col("ts") + F.make_dt_interval(mins=tables.item_key().cast("int"))).alias("arrived")
    rows = events.select("event_id", "ts", arrived)
    position = times.to_millis(F.col("arrived"))
    return lateness.marked(
        rows, "ts", ("arrived", "event_id"), position, ARRIVAL_DELAY, ARRIVAL_SIZE, ARRIVAL_SLIDE, ARRIVAL_WIDTHS
    )


def gated_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Every event but a sign-up is a reading; it passes while a sign-up of the same user holds the gate open, for `k` minutes."""
    events = tables.load(spark, folder, "events")
    measured = events.where(~F.col("event_type").eqNullSafe("signup")).select(
        "event_id", F.col("user_id").alias("id"), "ts", F.col("value").alias("temperature")
    )
    switches = events.where(F.col("event_type") == "signup").select(
        F.col("user_id").alias("id"), "ts", (tables.item_key() * F.lit(60_000)).alias("duration_ms")
    )
    return gating.gated(measured, switches, "id")


def forwarded_texts(spark: SparkSession, folder: str) -> DataFrame:
    text = readings.reading_text(F.col("id"), F.col("ts"), F.col("temperature"))
    return gated_readings(spark, folder).select("event_id", text.alias("reading"))


def epoch_conversions(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.load(spark, folder, "events")
    seconds, millis = times.to_seconds(F.col("ts")), times.to_millis(F.col("ts"))
    return events.select(
        "event_id",
        seconds.alias("epoch_s"),
        millis.alias("epoch_ms"),
        times.from_seconds(seconds).alias("from_s"),
        times.from_millis(millis).alias("from_ms"),
        times.timestamp_text(times.from_millis(millis)).alias("text"),
        times.short_time(F.col("ts")).alias("short"),
    )


QUERIES = {
    "sensor_avg": sensor_avg,
    "sensor_avg_hourly": sensor_avg_hourly,
    "sensor_avg_folded": sensor_avg_folded,
    "geometric_means": geometric_means,
    "late_events": late_events,
    "gated_readings": gated_readings,
    "forwarded_texts": forwarded_texts,
    "epoch_conversions": epoch_conversions,
}

_MEAN = """
SELECT user_id AS id, time_bucket(INTERVAL {size}, ts, TIMESTAMP '1970-01-01') + INTERVAL {size} AS ts,
  round(avg((value - 32) * (5.0::DOUBLE / 9.0::DOUBLE)), 6) AS temperature
FROM events GROUP BY 1, 2"""
_GATED = """
WITH gated AS (
  SELECT event_id, user_id AS id, ts, value AS temperature FROM events v
  WHERE event_type IS DISTINCT FROM 'signup' AND EXISTS (
    SELECT 1 FROM events s
    WHERE s.event_type = 'signup' AND s.user_id = v.user_id AND s.ts <= v.ts
      AND v.ts < s.ts + to_minutes(CAST(json_extract_string(s.props, '$.k') AS INTEGER))))"""

SQL = {
    "sensor_avg": _MEAN.format(size="1 SECOND"),
    "sensor_avg_hourly": _MEAN.format(size="1 HOUR"),
    "sensor_avg_folded": _MEAN.format(size="1 HOUR").replace("user_id AS id", "event_type"),
    "geometric_means": """
SELECT event_type, round(exp(avg(ln(value)) FILTER (value > 0)), 6) AS mean FROM events GROUP BY event_type""",
    "late_events": """
WITH arriving AS (
  SELECT event_id, ts, ts + to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS arrived FROM events),
seen AS (
  SELECT *, max(CAST(floor(epoch_us(ts) / 1000) AS BIGINT)) OVER (ORDER BY arrived, event_id ROWS UNBOUNDED PRECEDING) - 1800000 AS mark FROM arriving)
SELECT event_id, ts, arrived, make_timestamp(mark * 1000) AS watermark,
  epoch_ms(time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01')) + 1800000 - 1 <= mark AS late
FROM seen""",
    "gated_readings": _GATED + "\nSELECT event_id, id, ts, temperature FROM gated",
    "forwarded_texts": _GATED
    + """
SELECT event_id, 'SensorReading(' || id || ',' || CAST(floor(epoch_us(ts) / 1000) AS BIGINT) || ',' || temperature || ') '
  || strftime(ts, '%m-%d_%H:%M:%S') AS reading
FROM gated""",
    "epoch_conversions": """
SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_s, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS epoch_ms,
  date_trunc('second', ts) AS from_s, date_trunc('millisecond', ts) AS from_ms,
  strftime(ts, '%Y-%m-%d %H:%M:%S.') || CASE WHEN rtrim(strftime(ts, '%g'), '0') = '' THEN '0'
    ELSE rtrim(strftime(ts, '%g'), '0') END AS text,
  strftime(ts, '%m-%d_%H:%M:%S') AS short
FROM events""",
}
