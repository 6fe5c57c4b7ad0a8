"""Training-data operators: their registered queries, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    alignment,
    chat,
    clustering,
    compression,
    exact,
    lines,
    mixing,
    parsing,
    semantic,
    simhash,
    suffix_tree,
    token_counts,
    urls,
)

MODULES = (
    urls, exact, compression, suffix_tree, mixing, semantic, simhash, token_counts, chat, parsing, alignment, clustering, lines,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}
