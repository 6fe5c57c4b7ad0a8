"""A caller's own aggregate and window function on streams; the same ones as in `operators.aggregates`.

Rows are grouped by key and window. An aggregate's state is its partial value alone; a window function's are the
window's rows, as lists of rows that are read back one after another. Results come out as the watermark passes the
window's end; a row is late when its window is over, not before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import times
from tidemark.operators.aggregates import END, START, Aggregate, WindowFunction

# Rows that are handed over, and held, at a time.
CHUNK = 1000
# The state variables, as the state's reader has to name them.
VALUE, ROWS = "value", "rows"


class _Windowed(StatefulProcessor):
    """Hands the rows of a group on as Arrow batches, and asks for a call at the end of its window."""

    def __init__(self, keys: list[str], payload: T.StructType, result: str):
        self.keys, self.payload = keys, payload
        self.names = T.StructType.fromDDL(result).fieldNames()  # read here, on the driver

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.schema = to_arrow_schema(self.payload)

    def batch(self, rows: Sequence[Any]) -> pa.RecordBatch:
        columns = [[row[field.name] for row in rows] for field in self.schema]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        seen = False
        while some := list(islice(rows, CHUNK)):
            seen = True
            self.take(some)
        if seen:
            self.handle.registerTimer(-(-key[-1] // 1000))
        return iter(())

    def named(self, key: Any, values: dict[str, Any]) -> Row:
        return Row(**dict(zip((*self.keys, "_start", "_end"), key, strict=True)), **values)

    def take(self, rows: list[Row]) -> None:
        raise NotImplementedError


class AggregateOfWindow(_Windowed):
    def __init__(self, keys: list[str], payload: T.StructType, aggregate: Aggregate):
        super().__init__(keys, payload, aggregate.result)
        self.aggregate = aggregate

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.value = handle.getValueState(VALUE, self.aggregate.partial)

    def take(self, rows: list[Row]) -> None:
        state = self.value.get()
        before = tuple(state) if state else self.aggregate.zero()
        self.value.update(self.aggregate.add(before, self.batch(rows)))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        state = self.value.get()
        if state:
            yield self.named(key, dict(zip(self.names, self.aggregate.finish(tuple(state)), strict=True)))
            self.value.clear()


class FunctionOfWindow(_Windowed):
    def __init__(self, keys: list[str], payload: T.StructType, function: WindowFunction, result: str):
        super().__init__(keys, payload, result)
        self.function = function

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.rows = handle.getListState(ROWS, self.payload)

    def take(self, rows: list[Row]) -> None:
        self.rows.appendList([tuple(row[field.name] for field in self.schema) for row in rows])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        bounds = tuple(times.instant(micros) for micros in key[-2:])
        for columns in self.function(tuple(key[:-2]), bounds, self.held()):
            for values in zip(*(columns[name] for name in self.names), strict=True):
                yield self.named(key, dict(zip(self.names, values, strict=True)))
        self.rows.clear()

    def held(self) -> Iterator[pa.RecordBatch]:
        rows = (dict(zip(self.schema.names, row, strict=True)) for row in self.rows.get())
        while some := list(islice(rows, CHUNK)):
            yield self.batch(some)


def _grouped(stream: DataFrame, keys: Sequence[str], ts: str, size: times.Span, slide: times.Span | None) -> tuple[DataFrame, T.StructType]:
    """Rows with the bounds of each of their windows in microseconds, and the window as their event time; the rows' own fields."""
    span = lambda value: f"{times.span_micros(value)} microseconds"
    window = F.window(ts, span(size), span(slide) if slide else None)
    # Zone-less, so that it is no event time: a row would be late by its own time.
    own = [F.col(c).cast("timestamp_ntz").alias(c) if c == ts else F.col(c) for c in stream.columns]
    rows = stream.withColumn("_w", window).select(*own, "_w", times.to_micros(F.col("_w.start")).alias("_start"), times.to_micros(F.col("_w.end")).alias("_end"))
    return rows, T.StructType([T.StructField(c, rows.schema[c].dataType) for c in stream.columns])


def _run(rows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, result: str) -> DataFrame:
    fields = T.StructType.fromDDL(result)
    bounds = [T.StructField(name, T.LongType()) for name in ("_start", "_end")]
    out = T.StructType([*(rows.schema[key] for key in keys), *bounds, *fields])
    found = rows.groupBy(*keys, "_start", "_end").transformWithState(processor, out, "Append", "EventTime")
    return found.select(
        *keys, F.timestamp_micros("_start").alias(START), F.timestamp_micros("_end").alias(END), *fields.fieldNames()
    )


def aggregated(
    stream: DataFrame, keys: Sequence[str], ts: str, size: times.Span, aggregate: Aggregate, slide: times.Span | None = None
) -> DataFrame:
    """The keys, the window's bounds and the aggregate's result of every closed window."""
    rows, payload = _grouped(stream, keys, ts, size, slide)
    return _run(rows, keys, AggregateOfWindow(list(keys), payload, aggregate), aggregate.result)


def by_window(
    stream: DataFrame, keys: Sequence[str], ts: str, size: times.Span, function: WindowFunction, result: str, slide: times.Span | None = None
) -> DataFrame:
    """The keys, the window's bounds and what `function` makes of all rows of every closed window."""
    rows, payload = _grouped(stream, keys, ts, size, slide)
    return _run(rows, keys, FunctionOfWindow(list(keys), payload, function, result), result)
