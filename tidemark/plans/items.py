"""Hot items: views per item over sliding windows, and the most viewed of each window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ranking, windows
from tidemark.plans import tables
from tidemark.sources import records

# Window, slide and length of the list.
SIZE, SLIDE, TOP = "60 minutes", "5 minutes", 3


def _views(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.load(spark, folder, "events").where(F.col("event_type") == "view")
    return events.select(tables.item_key().alias("item_id"), "ts")


def hot_item_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = windows.sliding_counts(_views(spark, folder), ["item_id"], "ts", SIZE, SLIDE)
    return counts.select("item_id", "window_end", "view_count")


def hot_items_top3(spark: SparkSession, folder: str) -> DataFrame:
    counts = hot_item_counts(spark, folder)
    return ranking.top(counts, ["window_end"], [F.desc("view_count"), F.asc("item_id")], TOP)


def hot_items_report(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.hot_items_report(hot_items_top3(spark, folder), TOP)


def behavior_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The events as `user,item,category,behavior,seconds` lines."""
    events = tables.load(spark, folder, "events")
    fields = [
        F.col("user_id").cast("string"),
        tables.item_key().cast("string"),
        F.pmod(tables.item_key(), F.lit(10)).cast("string"),
        F.col("event_type"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"),
    ]
    return events.select("event_id", F.concat_ws(",", *fields).alias("value"))


def csv_parse(spark: SparkSession, folder: str) -> DataFrame:
    return records.parse_behavior(behavior_lines(spark, folder))


QUERIES = {
    "hot_item_counts": hot_item_counts,
    "hot_items_top3": hot_items_top3,
    "hot_items_report": hot_items_report,
    "csv_parse": csv_parse,
}

_COUNTS = """
WITH views AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts
  FROM events WHERE event_type = 'view'),
counts AS (
  SELECT item_id, window_end, count(*) AS view_count
  FROM (
    SELECT item_id, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01')
      + to_minutes(5 * CAST(unnest(range(1, 13)) AS INTEGER)) AS window_end
    FROM views)
  GROUP BY item_id, window_end)"""
_TOP = (
    _COUNTS
    + """,
ranked AS (
  SELECT item_id, window_end, view_count, row_number() OVER (
    PARTITION BY window_end ORDER BY view_count DESC, item_id) AS rank
  FROM counts)"""
)

SQL = {
    "hot_item_counts": _COUNTS + "\nSELECT item_id, window_end, view_count FROM counts",
    "hot_items_top3": _TOP + "\nSELECT item_id, window_end, view_count, rank FROM ranked WHERE rank <= 3",
    "hot_items_report": _TOP
    + f"""
SELECT window_end,
  '{ranking.RULE.strip()}' || chr(10)
  || '{ranking.STAMP_LABEL}' || epoch_ms(window_end) || chr(10)
  || '{ranking.TIME_LABEL}' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
  || string_agg(printf('{ranking.ITEM_LINE.strip()}', rank, item_id, view_count, epoch_ms(window_end)) || chr(10), '' ORDER BY rank)
  || '{ranking.RULE.strip()}' || chr(10) || chr(10) AS report
FROM ranked WHERE rank <= {TOP} GROUP BY window_end""",
    "csv_parse": """
SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
  CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS INTEGER) AS category_id,
  event_type AS behavior, date_trunc('second', ts) AS ts
FROM events""",
}
