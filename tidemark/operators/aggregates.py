"""A caller's own aggregate and window function over groups, for what built-in functions don't compute."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions import times

# Groups whose partial values a task holds at once.
HELD = 50_000

START, END = "window_start", "window_end"


class Aggregate:
    """An aggregate whose partial values merge. `partial` and `result` are the fields of either, as DDL;
    values are tuples of these fields."""

    partial: str
    result: str

    def zero(self) -> tuple:
        """The partial value of no rows."""
        raise NotImplementedError

    def add(self, value: tuple, rows: pa.RecordBatch) -> tuple:
        """A partial value with more rows of its group added."""
        raise NotImplementedError

    def merge(self, one: tuple, other: tuple) -> tuple:
        """Two partial values of a group as one."""
        raise NotImplementedError

    def finish(self, value: tuple) -> tuple:
        """The result of a group."""
        raise NotImplementedError


def _fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def groups_of(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of each group in a batch, under the values of its keys."""
    code = np.zeros(batch.num_rows, np.int64)
    for key in keys:
        encoded = pc.dictionary_encode(batch.column(key), null_encoding="encode")
        code = code * max(1, len(encoded.dictionary)) + encoded.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    whole = batch.take(pa.array(order))
    for begin, end in zip(starts, np.append(starts[1:], len(order)), strict=True):
        part = whole.slice(begin, end - begin)
        yield tuple(part.column(key)[0].as_py() for key in keys), part


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def partials(df: DataFrame, keys: Sequence[str], aggregate: Aggregate, held: int = HELD) -> DataFrame:
    """The keys and the partial value of the rows of each group in each task; once more for a group that
    comes back after `held` others."""
    kind = T.StructType([*(df.schema[key] for key in keys), *_fields(aggregate.partial)])
    schema = to_arrow_schema(kind)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values: dict[tuple, tuple] = {}
        for batch in batches:
            for key, rows in groups_of(batch, keys):
                values[key] = aggregate.add(values.get(key) or aggregate.zero(), rows)
            if len(values) > held:
                yield _batch([(*key, *value) for key, value in values.items()], schema)
                values.clear()
        if values:
            yield _batch([(*key, *value) for key, value in values.items()], schema)

    return df.mapInArrow(add_up, kind)


def aggregated(df: DataFrame, keys: Sequence[str], aggregate: Aggregate, held: int = HELD) -> DataFrame:
    """The keys and the aggregate's result of every group; all columns of `df` are handed to it.

    Rows are added up in the task they are in. Only partial values are exchanged and merged, one after
    another, so a key with a third of all rows sends one row for each task.
    """
    return finished(partials(df, keys, aggregate, held), keys, aggregate)


def finished(values: DataFrame, keys: Sequence[str], aggregate: Aggregate) -> DataFrame:
    """The keys and the result of every group from its partial values."""
    result = T.StructType([*(values.schema[key] for key in keys), *_fields(aggregate.result)])
    schema, names = to_arrow_schema(result), _fields(aggregate.partial).fieldNames()

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = None
        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
                value = row if value is None else aggregate.merge(value, row)
        yield _batch([(*(part.as_py() for part in key), *aggregate.finish(value))], schema)

    return values.groupBy(*keys).applyInArrow(merge, result)


WindowFunction = Callable[[tuple, tuple, Iterator[pa.RecordBatch]], Iterator[dict[str, list[Any]]]]


def by_window(
    df: DataFrame, keys: Sequence[str], ts: str, size: times.Span, function: WindowFunction, result: str, slide: times.Span | None = None
) -> DataFrame:
    """The keys, the window's bounds and what `function` makes of all rows of each group.

    It is called as function(keys, (start, end), batches), once for each group, and gives columns (`result` as
    DDL) as often as it likes. The rows come as Arrow batches, one at a time, so a group of any size is
    handed over in bounded memory; it is one task's, as the whole of it has to be seen in one place.
    """
    span = lambda value: f"{times.span_micros(value)} microseconds"
    window = F.window(ts, span(size), span(slide) if slide else None)
    kind = df.schema[ts].dataType
    rows = df.withColumn("_w", window).select(
        *df.columns, F.col("_w.start").cast(kind).alias(START), F.col("_w.end").cast(kind).alias(END)
    )
    return on_groups(rows, keys, function, result)


def on_groups(rows: DataFrame, keys: Sequence[str], function: WindowFunction, result: str) -> DataFrame:
    """`by_window` of rows that carry the bounds of their window."""
    whole = T.StructType([*(rows.schema[name] for name in (*keys, START, END)), *_fields(result)])
    schema, count = to_arrow_schema(whole), len(keys) + 2

    def call(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = tuple(part.as_py() for part in key)
        given = (batch.drop_columns([START, END]) for batch in batches)
        for columns in function(bounds[:-2], bounds[-2:], given):
            size = len(next(iter(columns.values())))
            arrays = [pa.array([value] * size, field.type) for value, field in zip(bounds, schema)]
            arrays += [pa.array(columns[field.name], field.type) for field in list(schema)[count:]]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows.groupBy(*keys, START, END).applyInArrow(call, whole)
