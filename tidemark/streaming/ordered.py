"""Keyed rows handed on in order of event time."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from typing import Any

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

AT = "_at"
# Rows in one value of the map at most, and so moved to or from state at a time.
CHUNK = 1000
# Microseconds of event time that are handed on together.
BUCKET = 1_000_000

# The state variables, as the state's reader has to name them.
WAITING, PENDING, ALARM = "waiting", "pending", "alarm"


class Alarm:
    """The one live timer of a key: set anew, it takes the place of the one before."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle = handle
        self.at = handle.getValueState(ALARM, "at bigint")

    def set(self, at: int | None, fired: bool = False) -> None:
        """Ring at `at` (milliseconds), or no more. A timer that has `fired` is gone by itself."""
        state = self.at.get()
        before = state[0] if state else None
        if at == before and not fired:
            return
        if before is not None and not fired:
            self.handle.deleteTimer(before)
        if at is None:
            self.at.clear()
        else:
            self.handle.registerTimer(at)
            self.at.update((at,))


class InOrder(StatefulProcessor):
    """Holds rows back until the watermark passes their bucket of time, then hands them on sorted.

    Rows carry their time as microseconds in `_at`; `tie` names the columns that order equal
    times. What is held is what arrived within the watermark's delay, in a map by bucket and part: a
    firing reads the buckets that are over and no others, each once, a bucket at a time. A key has
    one timer, at the end of its first bucket or where `later` asks for a call, whichever
    comes first. Subclasses implement `ready`, and `later` where they wait for a time without rows.
    """

    def __init__(self, held: T.StructType, tie: tuple[str, ...], bucket: int = BUCKET):
        if bucket % 1000:
            raise ValueError("a bucket is a whole number of milliseconds")
        self.held, self.bucket = held, bucket
        self.order = [held.fieldNames().index(c) for c in (AT, *tie)]
        self.names = held.fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        rows = T.StructType([T.StructField("rows", T.ArrayType(self.held))])
        self.waiting = handle.getMapState(WAITING, "bucket bigint, part int", rows)
        self.pending = handle.getValueState(PENDING, "buckets array<struct<bucket:bigint,parts:int>>")
        self.alarm = Alarm(handle)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        pending = self._pending()
        arrived = (tuple(row[name] for name in self.names) for row in rows)
        while some := list(islice(arrived, CHUNK)):
            dealt: dict[int, list[tuple]] = {}
            for row in some:
                dealt.setdefault(row[self.order[0]] // self.bucket, []).append(row)
            for bucket, part in dealt.items():
                number = pending.get(bucket, 0)
                self.waiting.updateValue((bucket, number), (part,))
                pending[bucket] = number + 1
        self._keep(pending)
        self._set_alarm(pending, False)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        over = timerValues.getCurrentWatermarkInMs() * 1000 // self.bucket  # buckets below are complete
        pending = self._pending()
        due = sorted(bucket for bucket in pending if bucket < over)
        yield from self.ready(key, self._rows(due, pending), over * self.bucket)
        if due:
            self._keep(pending)
        self._set_alarm(pending, True)

    def ready(self, key: Any, rows: Iterator[dict[str, Any]], passed: int) -> Iterator[Row]:
        """Rows due now, in order; all rows before `passed` (microseconds) have then been handed on."""
        raise NotImplementedError

    def later(self) -> int | None:
        """The time (microseconds) that must have passed for a call without rows; None for no call."""
        return None

    def _rows(self, due: list[int], pending: dict[int, int]) -> Iterator[dict[str, Any]]:
        for bucket in due:
            rows: list[tuple] = []
            for part in range(pending.pop(bucket)):
                rows += [tuple(row) for row in self.waiting.getValue((bucket, part))[0]]
                self.waiting.removeKey((bucket, part))
            rows.sort(key=lambda row: [row[i] for i in self.order])
            yield from (dict(zip(self.names, row)) for row in rows)

    def _pending(self) -> dict[int, int]:
        state = self.pending.get()
        return {bucket: parts for bucket, parts in state[0]} if state else {}

    def _keep(self, pending: dict[int, int]) -> None:
        if pending:
            self.pending.update((sorted(pending.items()),))
        else:
            self.pending.clear()

    def _set_alarm(self, pending: dict[int, int], fired: bool) -> None:
        ends = [min(pending) + 1] if pending else []
        at = self.later()
        if at is not None:
            ends.append(-(-at // self.bucket))
        self.alarm.set(min(ends) * self.bucket // 1000 if ends else None, fired)
