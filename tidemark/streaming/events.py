"""Event time of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ascending times, no waiting: a window closes when a later time has been seen.
ASCENDING = "0 seconds"
# Ascending times for patterns and gates: an event at the latest time seen so far is not late.
ASCENDING_TIES = "1 millisecond"
# Fixed value: the disorder allowed among sensor readings.
SENSOR_DISORDER = "5 seconds"


def event_time(stream: DataFrame, ts: str = "ts", delay: str = ASCENDING) -> DataFrame:
    """Make `ts` the event time, complete up to `delay` before the latest time seen.

    Watermarks need a time with a zone, so zone-less times are taken as in the session's zone,
    which the settings pin to UTC.
    """
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
