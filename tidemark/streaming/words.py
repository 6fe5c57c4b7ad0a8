"""Running word counts on streams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class RunningCount(StatefulProcessor):
    """Gives each row of a key back with the number of counted rows of the key so far."""

    def __init__(self, columns: list[str], out: str):
        self.columns, self.out = columns, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state = self.count.get()
        before = n = state[0] if state else 0
        for row in rows:
            n += row["_counted"]
            yield Row(**{c: row[c] for c in self.columns}, **{self.out: n if row["_counted"] else None})
        if n > before:
            self.count.update((n,))


def running_counts(words: DataFrame, counted: Column | None = None, out: str = "running") -> DataFrame:
    """Each word with its count so far, one row per occurrence, in the order of arrival.

    Words that do not meet `counted` pass with a null count and leave no state.
    """
    schema = T.StructType([*words.schema.fields, T.StructField(out, T.LongType())])
    marked = words.withColumn("_counted", F.lit(True) if counted is None else counted)
    processor = RunningCount(words.columns, out)
    return marked.groupBy("word").transformWithState(processor, schema, "Append", "None")
