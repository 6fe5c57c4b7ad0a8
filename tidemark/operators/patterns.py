"""Adjacent-event patterns with a time bound.

Two events match when the second is the very next event of the same key and comes strictly less
than `within` after the first. Events are cut into blocks of time per key, and an event is also
shown to the block before when it is close enough to follow an event there. Everything is then
decided inside a block with one exchange, and a key with most of the rows spreads over its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators.running import block_of

SUCCESS, TIMEOUT = "success", "timeout"


def followed(
    events: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str],
    within: times.Span,
    block: times.Span | None = None,
    shown: Sequence[str] | None = None,
    out: str = "next",
) -> DataFrame:
    """Every event with the struct of the next event of its key, or null if none comes in time.

    Ties in `ts` are ordered by `tie`; `shown` are the next event's columns to carry, all of them
    unless given. A block is eight bounds wide unless given; any width gives the same result,
    narrower ones split a busy key further at the price of more copies.
    """
    bound = times.span_micros(within)
    width = times.span_micros(block) if block else 8 * bound
    at = times.to_micros(F.col(ts))
    own, shown_from = block_of(F.col("_at"), width), block_of(F.col("_at") - F.lit(bound - 1), width)
    blocks = F.when(F.col("_from") == F.col("_own"), F.array("_own")).otherwise(F.sequence("_from", "_own"))
    placed = (
        events.where(F.col(ts).isNotNull())
        .withColumn("_at", at)
        .withColumns({"_own": own, "_from": shown_from})
        .select(*events.columns, "_at", "_own", F.explode(blocks).alias("_block"))
    )
    order = Window.partitionBy(key, "_block").orderBy("_at", *tie)
    carried = F.struct(*[F.col(c) for c in (events.columns if shown is None else shown)])
    nearest = placed.withColumns({out: F.lead(carried).over(order), "_next_at": F.lead("_at").over(order)})
    in_time = F.col("_next_at") - F.col("_at") < bound
    return (
        nearest.where(F.col("_own") == F.col("_block"))
        .withColumn(out, F.when(in_time, F.col(out)))
        .select(*events.columns, out)
    )


def pairs(
    events: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str],
    first: Column,
    second: Column,
    within: times.Span,
    block: times.Span | None = None,
) -> DataFrame:
    """Events that meet `first` whose next event meets `second` in time, with that event as `next`.

    Matches may overlap: three such events in a row give two.
    """
    marked = events.withColumn("_first", first).withColumn("_second", second)
    matched = followed(marked, key, ts, tie, within, block).where(F.col("_first") & F.col("next._second"))
    second_event = F.struct(*[F.col(f"next.{c}").alias(c) for c in events.columns])
    return matched.select(*events.columns, second_event.alias("next"))


def sequence_or_timeout(
    events: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str],
    first: Column,
    second: Column,
    within: times.Span,
    block: times.Span | None = None,
    out: str = "result",
) -> DataFrame:
    """Events that meet `first`, with `success` when the next event meets `second` in time and
    `timeout` when no event comes in time. Any other next event in time leaves no row.

    The table is the whole input, so an event without a successor times out.
    """
    marked = events.withColumn("_first", first).withColumn("_second", second)
    after = followed(marked, key, ts, tie, within, block, ["_second"])
    result = F.when(F.col("next").isNull(), TIMEOUT).when(F.col("next._second"), SUCCESS)
    return (
        after.where("_first")
        .withColumn(out, result)
        .where(F.col(out).isNotNull())
        .drop("_first", "_second", "next")
    )
