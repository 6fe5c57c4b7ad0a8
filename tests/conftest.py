import os
import time

import pytest

from tidemark.session import session


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="3",
        spark__driver__memory="4g",
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def replay(spark, tmp_path):
    """A table as a stream of micro-batches, one per list of rows."""
    count = 0

    def start(batches, schema):
        nonlocal count
        count += 1
        folder = tmp_path / f"source{count}"
        for number, rows in enumerate(batches):
            part = tmp_path / f"part{count}-{number}"
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(part))
            folder.mkdir(exist_ok=True)
            (file,) = part.glob("*.parquet")
            target = folder / f"{number:05}.parquet"
            file.rename(target)
            os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))
        fields = spark.createDataFrame([], schema).schema
        return spark.readStream.schema(fields).option("maxFilesPerTrigger", 1).parquet(str(folder))

    return start


@pytest.fixture
def watch(spark, tmp_path):
    """Rows of a stream that goes by the clock and so never ends: run until `enough` are out."""

    def run(stream, enough, seconds=120):
        query = (
            stream.writeStream.format("memory").queryName("watched")
            .option("checkpointLocation", str(tmp_path / "watched")).start()
        )
        deadline = time.monotonic() + seconds
        while time.monotonic() < deadline and query.isActive and spark.table("watched").count() < enough:
            time.sleep(0.5)
        query.stop()
        return [tuple(row) for row in spark.table("watched").collect()]

    return run


@pytest.fixture
def drain(spark, tmp_path):
    """All rows a stream puts out over the files there are, as tuples."""
    count = 0

    def run(stream, mode="append"):
        nonlocal count
        count += 1
        name = f"out{count}"
        query = (
            stream.writeStream.format("memory").queryName(name).outputMode(mode)
            .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        )
        query.awaitTermination(300)
        assert query.exception() is None
        return [tuple(row) for row in spark.table(name).collect()]

    return run


def on(df, *columns):
    """Rows as sorted tuples of the columns."""
    return sorted(tuple(row) for row in df.select(*columns).collect())

