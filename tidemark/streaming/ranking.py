"""The first rows of every window as a stream: window counts feed further stateful operators.

Counts come out when their window closes, and carry the window's time as their event time. From there one
operator keeps the first `n` rows of each window and shard, and a second one the first `n` of the
window among those, so a window with very many keys spreads over `shards` tasks, and no state holds
more than `n` rows. Both are put out as the watermark passes the window's end, in append mode.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import times

# The event time of a window's rows: the last moment of the window.
TIME, END, SHARD = "_time", "window_end", "_shard"
SHARDS = 32


class TopOfWindow(StatefulProcessor):
    """Keeps the first `n` rows of its group: most `count` first, then smallest `key`."""

    def __init__(self, key: str, count: str, kind: str, n: int, gathered: bool):
        self.key, self.count, self.kind, self.n, self.gathered = key, count, kind, n, gathered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", f"time timestamp, end bigint, rows array<struct<n:bigint,key:{self.kind}>>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state = self.best.get()
        first = next(rows, None)
        if first is None:
            return iter(())
        given = ((row[self.count], row[self.key]) for row in chain([first], rows))
        held = ((n, name) for n, name in state[2]) if state else ()
        best = heapq.nsmallest(self.n, chain(held, given), key=lambda pair: (-pair[0], pair[1] is None, pair[1]))
        self.best.update((first[TIME], first["_end"], best))
        self.handle.registerTimer(first["_end"])
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        state = self.best.get()
        if not state:
            return
        time, end, rows = state
        if self.gathered:
            ranked = [(rank, name, n) for rank, (n, name) in enumerate(rows, 1)]
            yield Row(window_end=time, _end=end, rows=ranked)
        else:
            for n, name in rows:
                yield Row(**{TIME: time, "_end": end, self.key: name, self.count: n})
        self.best.clear()


def top_rows(counts: DataFrame, key: str, n: int, count: str = "view_count", shards: int = SHARDS) -> DataFrame:
    """window_end and rows (rank, key and count of the first `n`) of every closed window.

    counts: `key`, `count`, `window_end` and the window's event time as `window_time`, see `timed_counts`.
    """
    kind = counts.schema[key].dataType
    end = times.to_millis(F.col(END)).alias("_end")
    shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias(SHARD)
    rows = counts.select(F.col("window_time").alias(TIME), end, shard, key, count)
    out = T.StructType([
        T.StructField(TIME, T.TimestampType()), T.StructField("_end", T.LongType()),
        T.StructField(key, kind), T.StructField(count, T.LongType()),
    ])
    parts = TopOfWindow(key, count, kind.simpleString(), n, False)
    some = rows.groupBy("_end", SHARD).transformWithState(parts, out, "Append", "EventTime", eventTimeColumnName=TIME)
    ranked = T.StructType([
        T.StructField(END, T.TimestampType()), T.StructField("_end", T.LongType()),
        T.StructField("rows", T.ArrayType(T.StructType([
            T.StructField("rank", T.LongType()), T.StructField(key, kind), T.StructField(count, T.LongType()),
        ]))),
    ])
    whole = TopOfWindow(key, count, kind.simpleString(), n, True)
    top = some.groupBy("_end").transformWithState(whole, ranked, "Append", "EventTime")
    return top.select(F.timestamp_millis("_end").alias(END), "rows")


def timed_counts(stream: DataFrame, keys: Sequence[str], ts: str, size: times.Span, slide: times.Span) -> DataFrame:
    """`operators.windows.window_counts` of a stream with the event time of each window as `window_time`."""
    text = lambda span: f"{times.span_micros(span)} microseconds"
    counts = stream.groupBy(F.window(ts, text(size), text(slide)).alias("w"), *keys).agg(F.count(F.lit(1)).alias("view_count"))
    return counts.select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias(END), "view_count", F.window_time("w").alias("window_time")
    )
