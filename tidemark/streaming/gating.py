"""Forwarding of readings while a switch of the same key is on, on streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import times
from tidemark.operators.gating import NEVER, open_end
from tidemark.streaming.ordered import AT, Alarm, InOrder

SWITCH, READING = 0, 1
# The state variable of the latest end among a key's switches.
UNTIL = "until"
# The last millisecond that a time in microseconds can hold; a switch by the clock ends there at the latest.
LAST_MS = NEVER // 1000


class EventTimeGate(InOrder):
    """Passes a reading when a switch at or before its time is still open at its time."""

    def __init__(self, key: str, held: T.StructType, tie: tuple[str, ...], payload: list[str]):
        super().__init__(held, tie)
        self.key, self.payload = key, payload

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.until = handle.getValueState(UNTIL, "at bigint")

    def ready(self, key: Any, rows: Iterator[dict[str, Any]], passed: int) -> Iterator[Row]:
        until = self.later()
        for row in rows:
            if row["_kind"] == SWITCH:
                until = row["_end"] if until is None else max(until, row["_end"])
            elif until is not None and row[AT] < until:
                yield Row(**{self.key: key[0], AT: row[AT], **{c: row[c] for c in self.payload}})
        if until is None or until <= passed:
            self.until.clear()
        else:
            self.until.update((until,))

    def later(self) -> int | None:
        state = self.until.get()
        return state[0] if state else None


class ProcessingTimeGate(StatefulProcessor):
    """Passes a reading while a switch that arrived before it is still on by the clock.

    A switch turns the key on from its arrival for its duration; a later one may extend that, never
    shorten it. Rows count in the order they arrive. An extension deletes the timer that stood and sets
    its own, so a key has one timer however often it is extended.
    """

    def __init__(self, key: str, payload: list[str]):
        self.key, self.payload = key, payload

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.alarm = Alarm(handle)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        state = self.alarm.at.get()
        before = until = state[0] if state else 0
        for row in rows:
            if row["_kind"] == SWITCH:
                until = max(until, min(now + row["_duration"], LAST_MS))
            elif now < until:
                yield Row(**{self.key: key[0], **{c: row[c] for c in self.payload}})
        if until > before:
            self.alarm.set(until)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        """The key is off: nothing is kept of it."""
        self.alarm.set(None, fired=True)
        return iter(())


def gated(
    readings: DataFrame, switches: DataFrame, key: str, ts: str = "ts", duration_ms: str = "duration_ms"
) -> DataFrame:
    """Streaming form of `operators.gating.gated`; both streams must have a watermark on `ts`."""
    payload = [c for c in readings.columns if c not in (key, ts)]
    at = times.to_micros(F.col(ts))
    marked = readings.select(
        key, ts, at.alias(AT), F.lit(READING).alias("_kind"), F.lit(None).cast("bigint").alias("_end"), *payload
    )
    ends = switches.select(
        F.col(key).cast(readings.schema[key].dataType).alias(key),
        ts,
        at.alias(AT),
        F.lit(SWITCH).alias("_kind"),
        open_end(at, F.col(duration_ms)).alias("_end"),
        *[F.lit(None).cast(readings.schema[c].dataType).alias(c) for c in payload],
    )
    both = marked.unionByName(ends)
    held = T.StructType([T.StructField(c, both.schema[c].dataType) for c in (AT, "_kind", "_end", *payload)])
    output = T.StructType(
        [readings.schema[key], T.StructField(AT, T.LongType())]
        + [T.StructField(c, readings.schema[c].dataType) for c in payload]
    )
    processor = EventTimeGate(key, held, ("_kind",), payload)
    rows = both.groupBy(key).transformWithState(processor, output, "Append", "EventTime")
    return rows.withColumn(ts, F.timestamp_micros(AT)).select(*readings.columns)


def gated_by_join(
    readings: DataFrame,
    switches: DataFrame,
    key: str,
    identity: Sequence[str],
    longest: times.Span,
    ts: str = "ts",
    duration_ms: str = "duration_ms",
) -> DataFrame:
    """`gated` as an interval join of two streams, without any code of its own in the state.

    Both streams must have a watermark on `ts`. A switch is held until no reading can meet it any more, which
    is known from `longest`, the longest time one can be on (a longer one fails); a reading until no switch
    at or before its time can come. Readings that several switches pass are told by `identity` and put out once.
    """
    at = times.to_micros(F.col("_from"))
    span = times.span_micros(longest)
    too_long = F.raise_error(F.lit(f"a switch is on for longer than {longest}")).cast("bigint")
    on = switches.select(F.col(key).cast(readings.schema[key].dataType).alias("_key"), F.col(ts).alias("_from"), F.col(duration_ms).alias("_ms"))
    until = open_end(at, F.when(F.col("_ms") > span // 1000, too_long).otherwise(F.col("_ms")))
    on = on.select("_key", "_from", F.timestamp_micros(until).alias("_until"))
    met = (
        (F.col(key) == F.col("_key")) & (F.col(ts) >= F.col("_from")) & (F.col(ts) < F.col("_until"))
        & (F.col(ts) < F.col("_from") + F.expr(f"interval {span} microseconds"))
    )
    return readings.join(on, met).select(*readings.columns).dropDuplicatesWithinWatermark(list(identity))


def gated_by_clock(
    readings: DataFrame, switches: DataFrame, key: str, duration_ms: str = "duration_ms"
) -> DataFrame:
    """Readings that arrive while their key is switched on; times are those of arrival."""
    payload = [c for c in readings.columns if c != key]
    marked = readings.select(
        key, F.lit(READING).alias("_kind"), F.lit(None).cast("bigint").alias("_duration"), *payload
    )
    on = switches.where(F.col(duration_ms).isNotNull()).select(
        F.col(key).cast(readings.schema[key].dataType).alias(key),
        F.lit(SWITCH).alias("_kind"),
        F.col(duration_ms).cast("bigint").alias("_duration"),
        *[F.lit(None).cast(readings.schema[c].dataType).alias(c) for c in payload],
    )
    output = T.StructType(
        [readings.schema[key]] + [T.StructField(c, readings.schema[c].dataType) for c in payload]
    )
    both = marked.unionByName(on)
    rows = both.groupBy(key).transformWithState(ProcessingTimeGate(key, payload), output, "Append", "ProcessingTime")
    return rows.select(*readings.columns)
