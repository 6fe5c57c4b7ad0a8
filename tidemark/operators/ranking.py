"""Ranks inside groups: the first few of each, or all of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.session import durable

PART, INDEX, FROM, BEFORE = "_part", "_index", "_from", "_before"


def top(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """The first `n` rows of each group, numbered from 1.

    A row-number filter of this form is pruned to `n` rows per group in every task before the
    exchange, so a large group never travels whole.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    first = df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= n)
    return first.withColumn(out, F.col(out).cast("bigint"))


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str = "rank", total: str | None = None) -> DataFrame:
    """All rows of each group, numbered from 1 in `order`.

    Rows are range-partitioned by group and order together, so one large group is cut over many
    tasks, and numbered inside each task by place. Counts per task and group tell how many rows of
    a group lie in the tasks before. The placement is written out first, since task numbers may
    change when a lost task runs again; what `df` reads is read once, while the plan is built.
    `total` names a further column: the rows of the group.
    """
    place = [*[F.col(c) for c in group], *order]
    placed = durable(
        df.repartitionByRange(*place)
        .sortWithinPartitions(*place)
        .withColumn(INDEX, F.monotonically_increasing_id())
        .withColumn(PART, F.spark_partition_id())
    )
    starts = placed.groupBy(PART, *group).agg(F.count(F.lit(1)).alias("_n"), F.min(INDEX).alias(FROM))
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        F.col(PART).alias("_p"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        FROM,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(BEFORE),
        F.sum("_n").over(Window.partitionBy(*group)).alias("_total"),
    )
    same = reduce(and_, [placed[c].eqNullSafe(starts[f"_g{i}"]) for i, c in enumerate(group)])
    ranked = placed.join(starts.hint("merge"), (placed[PART] == starts["_p"]) & same)
    rank = F.col(INDEX) - F.col(FROM) + F.col(BEFORE) + F.lit(1)
    return ranked.select(*df.columns, rank.alias(out), *([F.col("_total").alias(total)] if total else []))


# The wording of the reports.
RULE = "====================================\n"
STAMP_LABEL = "TimeStamp: "
TIME_LABEL = "时间: "
ITEM_LINE = "No%d:  商品ID=%d  浏览量=%d  windowEnd=%d\n"
URL_LINE = "No%d:  URL=%s  流量=%d"


def hot_items_report(ranked: DataFrame, n: int) -> DataFrame:
    """One text per window from its first `n` items: `item_id, window_end, view_count, rank`.

    A group is at most `n` rows, so the text stays small.
    """
    entry = F.struct("rank", "item_id", "view_count")
    texts = ranked.where(F.col("rank") <= n).groupBy("window_end").agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    return texts.select("window_end", hot_items_text(F.col("window_end"), F.col("rows")).alias("report"))


def hot_items_text(window_end: Column, rows: Column) -> Column:
    """The report of one window from its rows (rank, item_id, view_count) in order."""
    end = times.to_millis(window_end)
    return F.concat(
        F.lit(RULE + STAMP_LABEL),
        end.cast("string"),
        F.lit("\n" + TIME_LABEL),
        times.timestamp_text(window_end),
        F.lit("\n"),
        F.array_join(F.transform(rows, lambda r: F.format_string(ITEM_LINE, r["rank"], r["item_id"], r["view_count"], end)), ""),
        F.lit(RULE + "\n"),
    )


def traffic_report_lines(ranked: DataFrame, total: str) -> DataFrame:
    """The full ranking as report lines `window_start, line_no, line`: `url, window_start,
    window_end, view_count, rank` and the rows of the window, `total`.

    A window may rank any number of URLs, so its report stays rows, never gathered into one text:
    ordered by `line_no` they read as the report.
    """
    body = F.format_string(URL_LINE, "rank", "url", "view_count")
    heading = F.array(
        F.struct(F.lit(0).cast("bigint").alias("line_no"), F.lit(RULE.strip()).alias("line")),
        F.struct(
            F.lit(1).cast("bigint").alias("line_no"),
            F.concat(F.lit(TIME_LABEL), times.timestamp_text(F.col("window_end"))).alias("line"),
        ),
    )
    entry = F.array(F.struct((F.col("rank") + 1).cast("bigint").alias("line_no"), body.alias("line")))
    closing = F.array(F.struct((F.col(total) + 2).cast("bigint").alias("line_no"), F.lit(RULE.strip()).alias("line")))
    none = F.slice(entry, 1, 0)
    shown = F.concat(
        F.when(F.col("rank") == 1, heading).otherwise(none), entry, F.when(F.col("rank") == F.col(total), closing).otherwise(none)
    )
    return ranked.select("window_start", F.explode(shown).alias("r")).select("window_start", "r.line_no", "r.line")
