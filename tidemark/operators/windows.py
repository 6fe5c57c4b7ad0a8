"""Counts and means per key and time window; window bounds are multiples of the slide from 1970."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators.running import block_of

BLOCK = "_block"


def window_counts(df: DataFrame, keys: Sequence[str], ts: str, size: times.Span, slide: times.Span) -> DataFrame:
    """Rows per key and sliding window, by copying each row into all its windows.

    The plain form: one exchange, but size / slide hash updates per row before it. It is the one
    for streams; tables are better served by `sliding_counts`.
    """
    window = F.window(ts, _text(size), _text(slide))
    counts = df.groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("view_count"))
    return counts.select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "view_count"
    )


def sliding_counts(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: times.Span,
    slide: times.Span,
    block: times.Span | None = None,
) -> DataFrame:
    """Rows per key and sliding window, from the changes between neighbouring windows.

    Rows are counted once per pane (one slide wide). A pane raises the count of its first window
    and lowers it again after its last, so two rows stand for its size / slide windows. Running
    sums over those changes give the counts, and only result rows are written out per window.

    Windows are cut into blocks of time, so one key's panes spread over tasks; a pane whose
    windows cross a block border is clipped into both. A group holds at most four rows per slide
    of one block, whatever the number of input rows.
    """
    size_us, slide_us = times.span_micros(size), times.span_micros(slide)
    if size_us % slide_us:
        return window_counts(df, keys, ts, size, slide)
    block_us = times.span_micros(block) if block else 24 * size_us
    block_us = max(block_us - block_us % slide_us, size_us)

    kind = df.schema[ts].dataType.simpleString()
    panes = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, times.aligned(times.to_micros(F.col(ts)), slide_us).alias("_pane"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # Window starts a pane counts in: the slide multiples in [first, pane], clipped per block.
    first = F.col("_pane") - F.lit(size_us - slide_us)
    blocks = F.sequence(block_of(first, block_us), block_of(F.col("_pane"), block_us))
    pieces = panes.withColumn(BLOCK, F.explode(blocks))
    block_start = F.col(BLOCK) * F.lit(block_us)
    block_end = block_start + F.lit(block_us)
    opens = F.greatest(first, block_start)
    closes = F.least(F.col("_pane") + F.lit(slide_us), block_end)
    change = F.array(
        F.struct(opens.alias("at"), F.col("_n").alias("d")),
        F.struct(closes.alias("at"), (-F.col("_n")).alias("d")),
    )
    # A fixed number of partitions: each row stands for many windows, so a count chosen from the
    # bytes of this exchange would put too many of them into one task.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = pieces.select(*keys, BLOCK, F.explode(change).alias("_c")).repartition(partitions, *keys, BLOCK)
    changes = spread.groupBy(*keys, BLOCK, F.col("_c.at").alias("_at")).agg(F.sum("_c.d").alias("_d"))
    by_time = Window.partitionBy(*keys, BLOCK).orderBy("_at")
    steps = changes.select(
        *keys,
        "_at",
        F.lead("_at").over(by_time).alias("_until"),
        F.sum("_d").over(by_time.rowsBetween(Window.unboundedPreceding, 0)).alias("view_count"),
    ).where((F.col("view_count") > 0) & F.col("_until").isNotNull())
    starts = F.sequence(F.col("_at"), F.col("_until") - F.lit(slide_us), F.lit(slide_us))
    return steps.select(*keys, "view_count", F.explode(starts).alias("_start")).select(
        *keys,
        F.timestamp_micros("_start").cast(kind).alias("window_start"),
        F.timestamp_micros(F.col("_start") + F.lit(size_us)).cast(kind).alias("window_end"),
        "view_count",
    )


def window_means(df: DataFrame, keys: Sequence[str], ts: str, value: Column, size: times.Span, out: str) -> DataFrame:
    """The mean of `value` per key and tumbling window, stamped with the window's end."""
    means = df.groupBy(F.window(ts, _text(size)).alias("w"), *keys).agg(F.avg(value).alias(out))
    return means.select(*keys, F.col("w.end").alias("ts"), out)


def _text(value: times.Span) -> str:
    return f"{times.span_micros(value)} microseconds"
