"""Record parsers from text lines, and in-memory rows.

Parsing is strict by default: a row that does not fit fails the job, as ANSI casts do. With
`strict=False` a bad field becomes null and the row is kept, so callers can route it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text, times


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """Literal rows under an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def _parsed(
    lines: DataFrame, column: str, separator: str, record: Callable[[Column], dict[str, Column]], kinds: dict[str, str], strict: bool
) -> DataFrame:
    """The records that `record` makes of the fields of each line; if strict, a row with a null field fails.

    Each step is a lambda over an array of one, so line, fields and record are computed once however
    often they are used, and `inline` keeps filters and pruning above: no bad row is passed by.
    """
    shape = ",".join(f"{name}:{kind}" for name, kind in kinds.items())

    def split(line: Column) -> Column:
        return F.struct(line.alias("line"), text.tokens(line, separator).alias("fields"))

    def filled(row: Column) -> Column:
        return F.struct(row["line"].alias("line"), F.struct(*[v.alias(n) for n, v in record(row["fields"]).items()]).alias("record"))

    def checked(row: Column) -> Column:
        missing = reduce(or_, [row["record"][name].isNull() for name in kinds])
        failed = F.raise_error(F.concat(F.lit("bad record: "), row["line"])).cast(f"struct<{shape}>")
        return F.when(row["line"].isNotNull() & missing, failed).otherwise(row["record"])

    rows = F.transform(F.transform(F.array(column), split), filled)
    return lines.select(F.inline(F.transform(rows, checked if strict else lambda row: row["record"])))


def _number(value: Column, kind: str) -> Column:
    """A whole number without spaces around it, else null."""
    return F.when(value.rlike(r"^[+-]?[0-9]+\z"), value.try_cast(kind))


def parse_behavior(lines: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """`user,item,category,behavior,epoch seconds` lines; further fields are ignored.

    A strict row is checked in all five fields, whichever of them are used.
    """
    kinds = {"user_id": "bigint", "item_id": "bigint", "category_id": "int", "behavior": "string", "ts": "timestamp_ntz"}

    def record(fields: Column) -> dict[str, Column]:
        columns = {
            name: F.get(fields, F.lit(i)) if kind == "string" else _number(F.get(fields, F.lit(i)), "bigint" if name == "ts" else kind)
            for i, (name, kind) in enumerate(kinds.items())
        }
        return columns | {"ts": times.from_micros(F.try_multiply(columns["ts"], F.lit(1_000_000)))}

    return _parsed(lines, column, ",", record, kinds, strict)


def parse_access_log(lines: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """Space-separated access log lines: address, time, method and URL at 0, 3, 5 and 6.

    The zone offset at 4 is not read: times are taken as UTC. Two spaces before the URL leave
    an empty field there; such rows are dropped. Empty fields at the end of a line count as missing.
    """
    kinds = {"ip": "string", "ts": "timestamp_ntz", "method": "string", "url": "string"}

    def record(fields: Column) -> dict[str, Column]:
        columns = {name: F.get(fields, F.lit(i)) for name, i in zip(kinds, (0, 3, 5, 6), strict=True)}
        return columns | {"ts": times.log_time(columns["ts"], strict=False)}

    return _parsed(lines, column, " ", record, kinds, strict).where(~F.col("url").eqNullSafe(""))
