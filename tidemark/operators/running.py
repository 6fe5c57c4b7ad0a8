"""Running aggregates that do not put a whole key into one task.

A window function ordered within a key sorts all rows of that key in one task, which fails for
a key that holds a large share of the data. Here the order of a key is cut into blocks of a
`position`: rows are aggregated inside their block, block totals are aggregated over the blocks
before, and the two are merged. Block totals can be cut into wider blocks in the same way, so the
longest list one task orders is about total / (product of the widths). A block's total is what has run up
to its last row, so rows and totals come out of one exchange, and the input is read once where
the rows are no wider than keys and order.

Blocks come from the data alone, never from task numbers, so a lost executor's work can be redone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Rows without a position come first, as nulls do in ascending order.
FIRST = -(2**63)


def block_of(position: Column, width: int) -> Column:
    """The number of the block of `width` a position falls in, rounding down below zero too."""
    return F.call_function("div", position - F.pmod(position, F.lit(width)), F.lit(width))


class Combine(NamedTuple):
    """How values combine inside a window, and what came before with what is local."""

    local: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]


def _plus(carry: Column, local: Column) -> Column:
    return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))


SUM = Combine(F.sum, _plus)
MAX = Combine(F.max, F.greatest)
COUNT = Combine(lambda value: F.row_number(), _plus)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    combine: Combine = SUM,
    position: Column | None = None,
    widths: Sequence[int] = (),
) -> DataFrame:
    """Add `out`: `value` combined over the rows of the key up to this one.

    COUNT counts rows. `position` is an integer expression that never decreases along `order`;
    `widths` are the block widths, finest first: the first in units of `position`, each further one
    in blocks of the one before. Without widths each key is one window. A null is no key: its rows
    are dropped. Without keys the whole table is one order.
    """
    for key in keys:  # not dropna, which the joins' own filters would repeat on one side only
        df = df.where(F.col(key).isNotNull())
    window = Window.partitionBy(*keys).orderBy(*order)
    if combine is not COUNT:
        window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not widths:
        return df.withColumn(out, combine.local(value).over(window).cast("bigint"))
    rows = df.withColumn("_block", _block(position, widths[0]))
    ordered = Window.partitionBy(*keys, "_block").orderBy(*order)
    window = ordered if combine is COUNT else ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({out: combine.local(value).over(window), "_last": _last(ordered)})
    totals = local.where("_last").select(*keys, "_block", F.col(out).alias("_total"))
    carries = _before(totals, keys, SUM if combine is COUNT else combine, widths[1:])
    carries = carries.where(F.col("_carry").isNotNull())
    merged = combine.merge(F.col("_carry"), F.col(out)).cast("bigint")
    joined = local.drop("_last").join(carries.hint("merge"), [*keys, "_block"], "left")
    return joined.withColumn(out, merged).drop("_block", "_carry")


def _last(ordered: WindowSpec) -> Column:
    """Whether a row ends its group; what has run up to it is the group's total, out of the same exchange."""
    return F.lead(F.lit(True)).over(ordered).isNull()


def _before(totals: DataFrame, keys: Sequence[str], combine: Combine, widths: Sequence[int]) -> DataFrame:
    """`keys, _block, _carry`: the totals (`_total`) of the key's earlier blocks combined, null for its first."""
    if not widths:
        earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(*keys, "_block", combine.local(F.col("_total")).over(earlier).alias("_carry"))
    ordered = Window.partitionBy(*keys, "_wide").orderBy("_block")
    so_far = lambda end: combine.local(F.col("_total")).over(ordered.rowsBetween(Window.unboundedPreceding, end))
    rows = totals.withColumn("_wide", _block(F.col("_block"), widths[0])).select(
        *keys, "_block", "_wide", so_far(-1).alias("_near"), so_far(0).alias("_all"), _last(ordered).alias("_last")
    )
    wide = rows.where("_last").select(*keys, F.col("_wide").alias("_block"), F.col("_all").alias("_total"))
    carries = _before(wide, keys, combine, widths[1:]).withColumnsRenamed({"_block": "_wide", "_carry": "_far"})
    merged = combine.merge(F.col("_far"), F.col("_near")).alias("_carry")
    return rows.join(carries, [*keys, "_wide"]).select(*keys, "_block", merged)


def _block(position: Column, width: int) -> Column:
    return F.coalesce(block_of(position, width), F.lit(FIRST))
