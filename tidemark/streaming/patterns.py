"""Adjacent-event patterns on streams; the same results as the batch forms, as the watermark passes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from tidemark.functions import times
from tidemark.operators.patterns import SUCCESS, TIMEOUT
from tidemark.streaming.ordered import AT, BUCKET, InOrder

NEXT = "_next_"
# The state variable of the event that waits for its successor.
FIRST = "first"


class NextEvent(InOrder):
    """Decides each first event by the next event of its key, or by none coming within the bound."""

    def __init__(self, key: str, held: T.StructType, tie: tuple[str, ...], bound: int, bucket: int = BUCKET):
        super().__init__(held, tie, bucket)
        self.key, self.bound = key, bound

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.first = handle.getValueState(FIRST, self.held)

    def ready(self, key: Any, rows: Iterator[dict[str, Any]], passed: int) -> Iterator[Row]:
        first = self._first()
        for row in rows:
            if first:
                if row[AT] - first[AT] >= self.bound:
                    yield self._result(key, first, None, TIMEOUT)
                elif row["_second"]:
                    yield self._result(key, first, row, SUCCESS)
            first = row if row["_first"] else None
        if first and first[AT] + self.bound <= passed:
            yield self._result(key, first, None, TIMEOUT)
            first = None
        if first:
            self.first.update(tuple(first[name] for name in self.names))
        else:
            self.first.clear()

    def later(self) -> int | None:
        first = self._first()
        return first[AT] + self.bound if first else None

    def _first(self) -> dict[str, Any] | None:
        state = self.first.get()
        return dict(zip(self.names, state)) if state else None

    def _result(self, key: Any, first: dict, second: dict | None, result: str) -> Row:
        shown = [name for name in self.names if name not in ("_first", "_second")]
        begun = {name: first[name] for name in shown}
        ended = {NEXT + name: second[name] if second else None for name in shown}
        return Row(**{self.key: key[0], **begun, **ended, "result": result})


def decided(
    events: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str],
    first: Column,
    second: Column,
    within: times.Span,
) -> DataFrame:
    """Events that meet `first`, once decided, with the `next` event and the `result`.

    `success`: the next event met `second` in time; `timeout`: no event came in time, and `next`
    is null. Any other next event in time leaves no row. `events` must have a watermark on `ts`.
    """
    payload = [c for c in events.columns if c not in (key, ts)]
    marked = events.select(
        key,
        ts,
        times.to_micros(F.col(ts)).alias(AT),
        *payload,
        F.coalesce(first, F.lit(False)).alias("_first"),
        F.coalesce(second, F.lit(False)).alias("_second"),
    )
    held = T.StructType([marked.schema[c] for c in (AT, *payload, "_first", "_second")])
    shown = [marked.schema[c] for c in (AT, *payload)]
    output = T.StructType(
        [
            events.schema[key],
            *[T.StructField(f.name, f.dataType) for f in shown],
            *[T.StructField(NEXT + f.name, f.dataType) for f in shown],
            T.StructField("result", T.StringType()),
        ]
    )
    processor = NextEvent(key, held, tuple(tie), times.span_micros(within))
    rows = marked.groupBy(key).transformWithState(processor, output, "Append", "EventTime")

    def columns(prefix: str) -> list[Column]:
        at = {key: F.col(key), ts: F.timestamp_micros(prefix + AT)}
        return [at.get(c, F.col(prefix + c) if c in payload else None).alias(c) for c in events.columns]

    following = F.when(F.col(NEXT + AT).isNotNull(), F.struct(*columns(NEXT)))
    return rows.select(*columns(""), following.alias("next"), "result")


def pairs(events: DataFrame, key: str, ts: str, tie: Sequence[str], first: Column, second: Column, within: times.Span) -> DataFrame:
    """Streaming form of `operators.patterns.pairs`."""
    found = decided(events, key, ts, tie, first, second, within)
    return found.where(F.col("result") == SUCCESS).drop("result")


def sequence_or_timeout(
    events: DataFrame, key: str, ts: str, tie: Sequence[str], first: Column, second: Column, within: times.Span
) -> DataFrame:
    """Streaming form of `operators.patterns.sequence_or_timeout`."""
    return decided(events, key, ts, tie, first, second, within).drop("next")
