"""Several outputs from one input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def split(df: DataFrame, **outputs: Column) -> dict[str, DataFrame]:
    """One DataFrame per named condition. Each is its own plan, so each condition reaches the
    scan and an output nobody reads costs nothing."""
    return {name: df.where(condition) for name, condition in outputs.items()}
