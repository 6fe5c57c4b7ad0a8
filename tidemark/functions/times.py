"""Epoch, log-time and span conversions. Zone-less timestamps are read as UTC, which is what
the session settings pin."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The log time format and the short display format.
LOG_TIME = "dd/MM/yyyy:HH:mm:ss"
SHORT_TIME = "MM-dd_HH:mm:ss"

Span = str | timedelta


def span(value: Span) -> timedelta:
    """A timedelta from itself or from text such as '60 minutes'."""
    if isinstance(value, timedelta):
        return value
    number, unit = value.split()
    unit = unit if unit.endswith("s") else unit + "s"
    return timedelta(**{unit: float(number)})


def span_micros(value: Span) -> int:
    return span(value) // timedelta(microseconds=1)


def instant(micros: int) -> datetime:
    """The zone-less time of microseconds since 1970."""
    return datetime(1970, 1, 1) + timedelta(microseconds=micros)


def from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis).cast("timestamp_ntz")


def from_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def to_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def to_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def aligned(micros: Column, step: int) -> Column:
    """The largest multiple of `step` at or below `micros`; exact for times before 1970 too."""
    return micros - F.pmod(micros, F.lit(step))


def log_time(text: Column, strict: bool = True) -> Column:
    """A log time such as 17/05/2015:10:05:03. Strict parsing fails on a bad value;
    otherwise it becomes null."""
    if strict:
        return F.to_timestamp_ntz(text, F.lit(LOG_TIME))
    return F.try_to_timestamp(text, F.lit(LOG_TIME)).cast("timestamp_ntz")


def timestamp_text(ts: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss.f` with the fraction's trailing zeros removed down to one digit."""
    fraction = F.rtrim(F.date_format(ts, "SSSSSS"), F.lit("0"))
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss."),
        F.when(fraction == "", F.lit("0")).otherwise(fraction),
    )


def short_time(ts: Column) -> Column:
    return F.date_format(ts, SHORT_TIME)
