"""Compare every registered query with its SQL on one scale; `python tests/oracle.py [folder] [names]`."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, times at one resolution, rows in one order."""
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if str(frame[column].dtype).startswith("datetime"):
            frame[column] = frame[column].astype("datetime64[us]")
        elif frame[column].dtype == object or str(frame[column].dtype).startswith("str"):
            frame[column] = frame[column].astype(object)
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None where both hold the same rows, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got, want = normal(got), normal(want)
    kinds = [(c, got[c].dtype, want[c].dtype) for c in got.columns if got[c].dtype != want[c].dtype]
    if kinds:
        return f"types {kinds}"
    unequal = (got != want) & ~(got.isna() & want.isna())
    if unequal.any(axis=None):
        at = unequal.any(axis=1).idxmax()
        return f"first difference {got.loc[at].to_dict()} != {want.loc[at].to_dict()}"
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as contract
    from tidemark.session import session

    spark = session(
        master=f"local[{os.environ.get('BENCH_CPUS', 8)}]", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__sql__execution__arrow__pyspark__enabled="true",
    )
    spark.sparkContext.setLogLevel("OFF")
    sqls, failed = contract.oracle_sql(), 0
    connection = database(folder)
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            got = query(spark, folder).toPandas()
        except Exception as error:
            failed += 1
            print(f"FAIL {name:24} {str(error)[:600]}", flush=True)
            continue
        spent = time.time() - begin
        problem = difference(got, connection.execute(sqls[name]).df()) if name in sqls else None
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:24} {len(got):8} rows {spent:6.2f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(folder, sys.argv[2:]))
