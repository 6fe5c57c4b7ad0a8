"""Helpers of the operators: cut points in the shared folder, words, folds."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    Where the session names none, as in tests, the warehouse takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    path = f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    for paths in _noted:
        paths.append(path)
    return path


#: Lists that note the folders made while they are here.
_noted: list[list[str]] = []


@contextmanager
def noting() -> Iterator[list[str]]:
    """The folders that are made in this block, in order; for `removed`, once nothing reads them any more."""
    paths: list[str] = []
    _noted.append(paths)
    try:
        yield paths
    finally:
        _noted.pop()  # blocks end in turn


def removed(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch folders."""
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other values of its runtime settings in this block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def saved(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read again: a cut in the lineage that outlives executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(docs: DataFrame) -> DataFrame:
    """`docs` as `row` (all its columns) and `at` (file and row index), the place of each row.

    Rows that don't come straight from Parquet files are written to the shared folder first.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")

    def placed(rows: DataFrame) -> DataFrame:
        place = rows.metadataColumn("_metadata")  # the files', also beside a column of that name
        return rows.select(whole, F.struct(place["file_path"].alias("file"), place["row_index"].alias("index")).alias("at"))

    try:
        return placed(docs)
    except Exception as error:
        if "UNRESOLVED_COLUMN" not in str(error):
            raise
    return placed(saved(docs))


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without_spaces(text: Column) -> Column:
    return reduce(lambda t, space: F.replace(t, F.lit(space), F.lit("")), SPACES, text)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`."""
    return F.crc32(key.cast("string").cast("binary")) % parts
