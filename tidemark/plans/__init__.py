"""The registered queries: each on whole tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import items, logs, pairing, sensors, texts

Query = Callable[[SparkSession, str], DataFrame]

MODULES = (texts, items, logs, sensors, pairing)


def queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
