"""Forwarding of readings while a switch of the same key is on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import running

# Switches come before readings of the same time.
ORDER, UNTIL = ("_at", "_kind"), "_until"
NEVER = 2**63 - 1


def gated(
    readings: DataFrame,
    switches: DataFrame,
    key: str,
    ts: str = "ts",
    duration_ms: str = "duration_ms",
    block: times.Span = "1 hour",
) -> DataFrame:
    """The readings at a time `t` for which some switch of their key has `at <= t < at + duration`.

    Overlapping switches join up and a later one never shortens an earlier one, so a reading
    passes when the latest end among the switches up to its time lies after it. One ordered pass
    over both inputs finds that end; readings are never paired with switches.

    A key is cut into blocks of time, so a busy one spreads over tasks; the latest end is carried from
    block to block, whatever the lengths of the switches.
    """
    at = times.to_micros(F.col(ts))
    ends = switches.select(
        F.col(key).cast(readings.schema[key].dataType).alias(key), at.alias("_at"), open_end(at, F.col(duration_ms)).alias("_end")
    )
    return passing(readings, ends, key, ts, block)


def passing(readings: DataFrame, ends: DataFrame, key: str, ts: str = "ts", block: times.Span = "1 hour") -> DataFrame:
    """`gated` by switches given as their begin `_at` and end `_end` in microseconds."""
    marked = readings.select(
        F.col(key), times.to_micros(F.col(ts)).alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast("bigint").alias("_end"), F.struct(*readings.columns).alias("_row"),
    )
    opened = ends.where(F.col("_end") > F.col("_at")).select(
        key, "_at", F.lit(0).alias("_kind"), "_end", F.lit(None).cast(marked.schema["_row"].dataType).alias("_row")
    )
    timeline = running.running(
        marked.unionByName(opened), [key], ORDER, F.col("_end"), UNTIL, running.MAX, F.col("_at"), (times.span_micros(block),)
    )
    return timeline.where((F.col("_kind") == 1) & (F.col(UNTIL) > F.col("_at"))).select("_row.*")


def open_end(at: Column, duration_ms: Column) -> Column:
    """The end of a switch in microseconds; one too long to count never ends."""
    end = F.try_add(at, F.try_multiply(duration_ms, F.lit(1000)))
    return F.when(duration_ms.isNull() | (duration_ms <= 0), at).otherwise(F.coalesce(end, F.lit(NEVER)))
