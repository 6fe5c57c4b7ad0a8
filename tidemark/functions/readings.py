"""Sensor reading expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import times


def celsius(fahrenheit: Column) -> Column:
    """Double arithmetic in this order: decimal literals would change the last digits."""
    return (fahrenheit - F.lit(32.0)) * F.lit(5.0 / 9.0)


def reading_text(id: Column, ts: Column, temperature: Column) -> Column:
    """A forwarded reading as text, with its time in epoch milliseconds and in short form."""
    return F.format_string(
        "SensorReading(%s,%s,%s) %s",
        id.cast("string"),
        times.to_millis(ts).cast("string"),
        temperature.cast("string"),
        times.short_time(ts),
    )
