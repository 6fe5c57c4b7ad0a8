"""Adjacent-event patterns: repeated failures, and steps that follow in time or not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import patterns, routing
from tidemark.plans import tables

# Bounds that fit the spacing of the given events; the operator takes any.
FAIL_BOUND, ORDER_BOUND = "2 hours", "12 hours"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")


def login_fail_pairs(spark: SparkSession, folder: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    pairs = patterns.pairs(_events(spark, folder), "user_id", "ts", ["event_id"], failed, failed, FAIL_BOUND)
    return pairs.select(
        "user_id",
        F.col("event_id").alias("first_id"),
        F.col("next.event_id").alias("second_id"),
        F.col("next.event_type").alias("event_type"),
    )


def _orders(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    created, paid = F.col("event_type") == "click", F.col("event_type") == "purchase"
    results = patterns.sequence_or_timeout(
        _events(spark, folder), "user_id", "ts", ["event_id"], created, paid, ORDER_BOUND
    ).select("event_id", "user_id", "result")
    return routing.split(
        results, paid=F.col("result") == patterns.SUCCESS, late=F.col("result") == patterns.TIMEOUT
    )


def order_success(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder)["paid"]


def order_timeouts(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder)["late"]


QUERIES = {
    "login_fail_pairs": login_fail_pairs,
    "order_success": order_success,
    "order_timeouts": order_timeouts,
}

_NEXT = """
WITH followed AS (
  SELECT event_id, user_id, event_type, ts, lead(event_id) OVER w AS n_id,
    lead(event_type) OVER w AS n_type, lead(ts) OVER w AS n_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""

SQL = {
    "login_fail_pairs": _NEXT
    + """
SELECT user_id, event_id AS first_id, n_id AS second_id, n_type AS event_type FROM followed
WHERE event_type = 'error' AND n_type = 'error' AND n_ts - ts < INTERVAL 2 HOUR""",
    "order_success": _NEXT
    + """
SELECT event_id, user_id, 'success' AS result FROM followed
WHERE event_type = 'click' AND n_type = 'purchase' AND n_ts - ts < INTERVAL 12 HOUR""",
    "order_timeouts": _NEXT
    + """
SELECT event_id, user_id, 'timeout' AS result FROM followed
WHERE event_type = 'click' AND (n_ts IS NULL OR n_ts - ts >= INTERVAL 12 HOUR)""",
}
