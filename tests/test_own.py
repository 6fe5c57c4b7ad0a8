"""A caller's own aggregate and window function, lateness by arrival, the gate as a join, outputs that come again."""

import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from conftest import on
from pyspark.sql import functions as F
from test_streaming import EVENT, START, batches, event_rows

from tidemark.functions import text
from tidemark.operators import aggregates, gating, lateness, words
from tidemark.plans.sensors import GeometricMean
from tidemark.sinks import streams
from tidemark.streaming import events, gating as stream_gating

VALUES = "key bigint, name string, value double"


def value_rows(n):
    draw = random.Random(3)
    return [(0 if draw.random() < 0.34 else draw.choice([None, *range(1, 30)]), draw.choice(["a", None]), draw.choice([None, -1.0, draw.uniform(0.1, 9)])) for _ in range(n)]


@pytest.mark.parametrize(("keys", "held"), [(["key"], 50_000), (["key", "name"], 3), ([], 10)])
def test_own_aggregate(spark, keys, held):
    rows = value_rows(3000)
    want = defaultdict(list)
    for row in rows:
        want[tuple(row[VALUES.split(", ").index(f"{k} {'bigint' if k == 'key' else 'string'}")] for k in keys)].append(row[2])
    df = spark.createDataFrame(rows, VALUES).repartition(5)
    got = {tuple(r[: len(keys)]): r[-1] for r in aggregates.aggregated(df, keys, GeometricMean("value"), held).collect()}
    assert got.keys() == want.keys()
    for key, values in want.items():
        logs = [math.log(v) for v in values if v and v > 0]
        assert got[key] == (pytest.approx(math.exp(sum(logs) / len(logs))) if logs else None)
    empty = spark.createDataFrame([], VALUES)
    assert aggregates.aggregated(empty, ["key"], GeometricMean("value")).collect() == []


def test_a_hot_key_sends_one_row_for_each_task(spark):
    df = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id % 20) key", "double(id) value")
    assert aggregates.partials(df, ["key"], GeometricMean("value")).count() == 8 * 20


def test_whole_windows_come_in_batches(spark):
    """A window's rows come as several batches where they are many; results are any number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        rows = [(i, i % 2, "x", START + timedelta(seconds=i)) for i in range(1000)]

        def sizes(keys, bounds, given):
            seen = [batch.num_rows for batch in given]
            assert bounds[1] - bounds[0] == timedelta(minutes=10)
            yield {"n": [sum(seen)], "batches": [len(seen)]}
            yield {"n": [0, 1], "batches": [0, 0]}

        def sizes_of(keys, bounds, given):
            yield {"n": [sum(batch.num_rows for batch in given)]}

        got = aggregates.by_window(spark.createDataFrame(rows, EVENT), ["key"], "ts", "10 minutes", sizes, "n bigint, batches bigint")
        assert Counter((r.key, r.n) for r in got.collect()) == Counter({(k, n): c for k in (0, 1) for n, c in ((300, 1), (200, 1), (0, 2), (1, 2))})
        assert all(r.batches > 1 for r in got.where("n > 1").collect())
        slid = aggregates.by_window(spark.createDataFrame(rows[:60], EVENT), [], "ts", "60 seconds", sizes_of, "n bigint", "20 seconds")
        assert sorted(r.n for r in slid.collect()) == [20, 20, 40, 40, 60]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("widths", [(), (7,), (3, 5), (1, 2, 3)])
def test_lateness_by_arrival(spark, widths):
    """Against a walk over the arrivals: all windows of a row over, by the latest time before it."""
    draw = random.Random(5)
    rows = [(n, START + timedelta(seconds=n + draw.uniform(-120, 0)) if n % 50 else None) for n in range(400)]
    df = spark.createDataFrame(rows, "n bigint, ts timestamp_ntz").repartition(4)
    got = {r.n: (r.watermark, r.late) for r in lateness.marked(df, "ts", ["n"], F.col("n"), "5 seconds", "40 seconds", "20 seconds", widths).collect()}
    latest, late = None, 0
    for n, ts in rows:
        seconds = None if ts is None else math.floor((ts - datetime(1970, 1, 1)).total_seconds())
        mark = latest - timedelta(seconds=5) if latest else None
        closed = ts is not None and mark is not None and datetime(1970, 1, 1) + timedelta(seconds=seconds // 20 * 20 + 40, milliseconds=-1) <= mark
        late += closed
        assert got[n][1] == closed
        if ts is not None:
            cut = ts.replace(microsecond=ts.microsecond // 1000 * 1000)
            latest = cut if latest is None else max(latest, cut)
        assert got[n][0] == (latest - timedelta(seconds=5) if latest else None)
    assert late > 50


def test_gate_as_a_join(spark, replay, tmp_path):
    """Overlapping switches, the same rows as the batch gate, each once; what is held shrinks again."""
    rows = [(*row, 1000 * (row[0] * 37 % 110)) for row in event_rows(21, n=400, span=4000, kinds=("reading", "reading", "switch"))]
    schema = EVENT + ", duration_ms bigint"

    def sides(df):
        return df.where("kind != 'switch'").select("id", "key", "ts"), df.where("kind != 'reading'").select("key", "ts", "duration_ms")

    want = on(gating.gated(*sides(spark.createDataFrame(rows, schema)), "key"), "id", "key")
    end = [[(-1, -1, kind, datetime(2100, 1, 1) + timedelta(days=n), 0) for kind in ("reading", "switch")] for n in range(3)]
    stream = replay(batches(rows, 8) + end, schema)
    readings, switches = (events.event_time(side, delay="1 second") for side in sides(stream))
    got, held = [], []
    passed = stream_gating.gated_by_join(readings, switches, "key", ["id"], "2 minutes")
    query = streams.each_batch(passed, lambda batch, number: got.extend(on(batch, "id", "key")), str(tmp_path / "join"), availableNow=True)
    query.awaitTermination(300)
    assert query.exception() is None
    held = [sum(operator["numRowsTotal"] for operator in progress["stateOperators"]) for progress in query.recentProgress]
    assert 0 < len(want) < len(rows) / 2 and sorted(got) == want
    assert max(held[2:8]) < len(rows) / 2 and held[-1] <= 12  # only rows near the watermark, and the end's own
    late = replay([[(0, 0, "switch", START, 999_000)], [(1, 0, "reading", START, 0)]], schema)
    readings, switches = (events.event_time(side) for side in sides(late))
    query = streams.each_batch(
        stream_gating.gated_by_join(readings, switches, "key", ["id"], "2 minutes"), lambda batch, number: batch.collect(), str(tmp_path / "long"), availableNow=True
    )
    with pytest.raises(Exception, match="on for longer than 2 minutes"):
        query.awaitTermination(300)


def test_outputs_of_a_batch_that_comes_again(spark, replay, tmp_path):
    """The second output fails in the second batch; started again, the stream has every row once in both."""
    stream = words.words(replay([[("to be or not",)], [("wonder question",), ("to be",)]], "value string"))
    out = {name: str(tmp_path / name) for name in ("counted", "rejected")}
    write = {name: streams.parquet_batches(path) for name, path in out.items()}
    failed = []

    def once_failing(batch, number):
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("lost")
        write["rejected"](batch, number)

    def run():
        outputs = {"counted": (words.short(), write["counted"]), "rejected": (~words.short(), once_failing)}
        return streams.to_outputs(stream, outputs, str(tmp_path / "state"), availableNow=True)

    with pytest.raises(Exception, match="lost"):
        run().awaitTermination(300)
    assert on(streams.committed(spark, out["counted"], "word string"), "word", "batch") == [("be", 0), ("be", 1), ("not", 0), ("or", 0), ("to", 0), ("to", 1)]
    assert streams.committed(spark, out["rejected"], "word string").count() == 0
    run().awaitTermination(300)
    assert on(streams.committed(spark, out["counted"], "word string"), "word") == [("be",), ("be",), ("not",), ("or",), ("to",), ("to",)]
    assert on(streams.committed(spark, out["rejected"], "word string"), "word", "batch") == [("question", 1), ("wonder", 1)]
    # A batch cut off half-way has no mark: not read, and written over.
    (tmp_path / "rejected" / "batch=1" / streams.MARK).unlink()
    assert streams.committed(spark, out["rejected"], "word string").count() == 0
    write["rejected"](spark.createDataFrame([("again",)], "word string"), 1)
    write["rejected"](spark.createDataFrame([("never",)], "word string"), 1)
    assert on(streams.committed(spark, out["rejected"], "word string"), "word") == [("again",)]
    assert streams.committed(spark, str(tmp_path / "nowhere"), "word string").collect() == []


def test_length_in_utf16_units(spark):
    values = ["", "abcde", "abcdef", "日本語です", "日本語でした", "𝄞𝄞", "𝄞𝄞a", "𝄞𝄞𝄞", "é" * 5, "é" * 6, "🎉a🎉", "\x00" * 5, "​abcd"]
    df = spark.createDataFrame([(v,) for v in values], "word string")
    got = df.select("word", text.utf16_length(F.col("word")).alias("n"), words.short().alias("short")).collect()
    for row in got:
        units = len(row.word.encode("utf-16-le")) // 2
        assert (row.n, row.short) == (units, units <= 5)


def test_rows_of_a_batch_by_key():
    batch = pa.RecordBatch.from_pydict({"a": [1, None, 1, 2, None], "b": ["x", "y", "x", None, "y"], "v": [1, 2, 3, 4, 5]})
    got = {key: rows.column("v").to_pylist() for key, rows in aggregates.groups_of(batch, ["a", "b"])}
    assert got == {(1, "x"): [1, 3], (None, "y"): [2, 5], (2, None): [4]}
    assert [rows.num_rows for _, rows in aggregates.groups_of(batch, [])] == [5]
