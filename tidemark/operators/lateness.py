"""Which rows of a table are late for their windows, by the order in which they arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import running


def marked(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    position: Column,
    delay: times.Span,
    size: times.Span,
    slide: times.Span | None = None,
    widths: Sequence[int] = (),
) -> DataFrame:
    """`df` with `watermark`, the latest time that arrived so far less `delay`, and `late`.

    A row is late when all its windows (`size` wide, every `slide`) were over on its arrival: their last
    moment, a millisecond before the end, lies at the watermark or before. Such rows a stream
    leaves out, if the watermark moves with every row. Times count in milliseconds.

    The latest time so far is a maximum over the whole table without any key: it is taken inside blocks of
    `position`, an integer that never decreases along `order`, and carried over the blocks; see `running`.
    Rows without a time have no window and are never late.
    """
    wait = times.span_micros(delay) // 1000
    if wait < 1:
        raise ValueError("a delay is a millisecond at least")
    step, width = (times.span_micros(span) // 1000 for span in (slide or size, size))
    at = times.to_millis(F.col(ts))
    seen = running.running(df, [], order, at, "_seen", running.MAX, position, widths)
    mark = F.col("_seen") - F.lit(wait)
    last = times.aligned(at, step) + F.lit(width - 1)
    kind = df.schema[ts].dataType
    return seen.select(
        *df.columns, F.timestamp_millis(mark).cast(kind).alias("watermark"), F.coalesce(last <= mark, F.lit(False)).alias("late")
    )
