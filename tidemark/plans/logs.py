"""URL traffic: access log lines, views per URL over sliding windows, and their ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import ranking, windows
from tidemark.plans import tables
from tidemark.sources import records

# Window and slide.
SIZE, SLIDE = "10 minutes", "5 seconds"


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The events as access log lines: every item is a page, and every tenth item has no URL."""
    events = tables.load(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "props")
    user = F.col("user_id")
    address = F.concat(
        F.lit("10.0."), F.shiftright(user, 8).cast("string"), F.lit("."), F.pmod(user, F.lit(256)).cast("string")
    )
    url = F.when(F.pmod(tables.item_key(), F.lit(10)) != 0, F.concat(F.lit("/item/"), tables.item_key()))
    line = F.concat_ws(
        " ",
        address,
        F.lit("-"),
        F.lit("-"),
        F.date_format("ts", times.LOG_TIME),
        F.lit("+0000"),
        F.when(F.col("event_type") == "click", "POST").otherwise("GET"),
        F.coalesce(url, F.lit("")),
        F.lit("HTTP/1.1"),
    )
    return events.select(line.alias("value"))


def access_log_parse(spark: SparkSession, folder: str) -> DataFrame:
    return records.parse_access_log(log_lines(spark, folder))


def url_traffic(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of every kind: all that parse and have a URL."""
    requests = records.parse_access_log(log_lines(spark, folder))
    return windows.sliding_counts(requests, ["url"], "ts", SIZE, SLIDE)


def _ranked(spark: SparkSession, folder: str, total: str | None = None) -> DataFrame:
    return ranking.numbered(url_traffic(spark, folder), ["window_start"], [F.desc("view_count"), F.asc("url")], total=total)


def url_traffic_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked(spark, folder)


def url_traffic_report(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.traffic_report_lines(_ranked(spark, folder, "n_rows"), "n_rows")


QUERIES = {
    "access_log_parse": access_log_parse,
    "url_traffic": url_traffic,
    "url_traffic_ranked": url_traffic_ranked,
    "url_traffic_report": url_traffic_report,
}

_LOG = """
WITH log AS (
  SELECT '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip, date_trunc('second', ts) AS ts,
    CASE WHEN event_type = 'click' THEN 'POST' ELSE 'GET' END AS method,
    '/item/' || json_extract_string(props, '$.k') AS url, event_type
  FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 <> 0)"""
_TRAFFIC = (
    _LOG
    + """,
traffic AS (
  SELECT url, window_start, window_start + INTERVAL 10 MINUTE AS window_end, count(*) AS view_count
  FROM (
    SELECT url, time_bucket(INTERVAL 5 SECOND, ts, TIMESTAMP '1970-01-01')
      - to_seconds(5 * CAST(unnest(range(0, 120)) AS INTEGER)) AS window_start
    FROM log)
  GROUP BY url, window_start)"""
)
_RANKED = (
    _TRAFFIC
    + """,
ranked AS (
  SELECT url, window_start, window_end, view_count, row_number() OVER (
    PARTITION BY window_start ORDER BY view_count DESC, url) AS rank
  FROM traffic)"""
)

SQL = {
    "access_log_parse": _LOG + "\nSELECT ip, ts, method, url FROM log",
    "url_traffic": _TRAFFIC + "\nSELECT url, window_start, window_end, view_count FROM traffic",
    "url_traffic_ranked": _RANKED + "\nSELECT url, window_start, window_end, view_count, rank FROM ranked",
    "url_traffic_report": _RANKED
    + f"""
SELECT window_start, CAST(rank + 1 AS BIGINT) AS line_no, printf('{ranking.URL_LINE}', rank, url, view_count) AS line FROM ranked
UNION ALL
SELECT DISTINCT window_start, CAST(0 AS BIGINT), '{ranking.RULE.strip()}' FROM ranked
UNION ALL
SELECT DISTINCT window_start, CAST(1 AS BIGINT), '{ranking.TIME_LABEL}' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' FROM ranked
UNION ALL
SELECT window_start, CAST(max(rank) + 2 AS BIGINT), '{ranking.RULE.strip()}' FROM ranked GROUP BY window_start""",
}
