"""Each scale form against a plain or brute-force one, with one key holding a third of the rows."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import on
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import gating, patterns, ranking, running, windows, words

START = datetime(2024, 1, 1)
SCHEMA = "id bigint, key bigint, kind string, ts timestamp_ntz"


def make(seed, n=2000, keys=20, span=7200, start=START, kinds=("create", "pay", "other")):
    draw = random.Random(seed)
    return [
        (
            i,
            0 if draw.random() < 0.34 else draw.randrange(1, keys),
            draw.choice(kinds),
            start + timedelta(microseconds=draw.randrange(span * 10) * 100_000),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("widths", [(), (1,), (7,), (7, 3), (2, 5, 3), (10_000,)])
def test_running_count_and_sum(spark, widths):
    df = spark.createDataFrame(make(1), SCHEMA)
    plain = Window.partitionBy("key").orderBy("id")
    want = df.withColumn("n", F.row_number().over(plain)).withColumn("s", F.sum("id").over(plain))
    counted = running.running(df, ["key"], ["id"], F.lit(1), "n", running.COUNT, F.col("id"), widths)
    both = running.running(counted, ["key"], ["id"], F.col("id"), "s", running.SUM, F.col("id"), widths)
    assert on(both, "id", "n", "s") == on(want, "id", "n", "s")


def test_running_without_position_or_key(spark):
    rows = [(1, "a", None), (2, "a", 5), (3, "a", 50), (4, None, 1)]
    df = spark.createDataFrame(rows, "id bigint, key string, at bigint")
    got = running.running(df, ["key"], ["at"], F.lit(1), "n", running.COUNT, F.col("at"), (10,))
    assert on(got, "id", "n") == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("start", [START, datetime(1969, 12, 31, 23)])
@pytest.mark.parametrize("block", [None, "10 minutes", "1 hour"])
def test_sliding_counts(spark, start, block):
    df = spark.createDataFrame(make(2, start=start), SCHEMA)
    got = windows.sliding_counts(df, ["key"], "ts", "10 minutes", "30 seconds", block)
    want = windows.window_counts(df, ["key"], "ts", "10 minutes", "30 seconds")
    columns = ("key", "window_start", "window_end", "view_count")
    assert on(got, *columns) == on(want, *columns)
    assert got.schema.simpleString() == want.select(got.columns).schema.simpleString()


def test_sliding_counts_keep_the_kind_of_time(spark):
    df = spark.createDataFrame(make(7, n=200), SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    got = windows.sliding_counts(df, ["key", "kind"], "ts", "10 minutes", "1 minute")
    want = windows.window_counts(df, ["key", "kind"], "ts", "10 minutes", "1 minute")
    assert dict(got.dtypes)["window_end"] == "timestamp"
    assert on(got, *want.columns) == on(want, *want.columns)


def test_sliding_window_bounds(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 10, 2)), (1, datetime(2024, 1, 1, 11))], "key bigint, ts timestamp_ntz")
    got = on(windows.sliding_counts(df, ["key"], "ts", "60 minutes", "5 minutes"), "window_end", "view_count")
    ends = [datetime(2024, 1, 1, 10, 5) + timedelta(minutes=5 * i) for i in range(24)]
    assert got == [(end, 1) for end in ends[:12]] + [(end, 1) for end in ends[12:24]][: len(got) - 12]
    assert got[11][0] == datetime(2024, 1, 1, 11) and got[12][0] == datetime(2024, 1, 1, 11, 5)


def test_slide_that_does_not_divide_the_size(spark):
    df = spark.createDataFrame(make(3, n=200), SCHEMA)
    got = windows.sliding_counts(df, ["key"], "ts", "60 seconds", "25 seconds")
    assert on(got, *got.columns) == on(windows.window_counts(df, ["key"], "ts", "60 seconds", "25 seconds"), *got.columns)


def test_means_carry_the_window_end(spark):
    rows = [("s", datetime(2024, 1, 1, 0, 0, 0, 100), 10.0), ("s", datetime(2024, 1, 1, 0, 0, 0, 900), 20.0), ("s", datetime(2024, 1, 1, 0, 0, 1), 5.0)]
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, t double")
    got = windows.window_means(df, ["id"], "ts", F.col("t"), "1 second", "t")
    assert on(got, "id", "ts", "t") == [("s", datetime(2024, 1, 1, 0, 0, 1), 15.0), ("s", datetime(2024, 1, 1, 0, 0, 2), 5.0)]


def test_top_and_numbered(spark):
    draw = random.Random(4)
    rows = [(0 if draw.random() < 0.4 else draw.randrange(50), draw.randrange(5), f"u{i}") for i in range(3000)]
    df = spark.createDataFrame(rows + [(None, 1, "x"), (None, 2, "y")], "g bigint, n bigint, url string")
    order = [F.desc("n"), F.asc("url")]
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
    columns = (F.coalesce("g", F.lit(-1)), "n", "url", "rank")
    assert on(ranking.numbered(df, ["g"], order), *columns) == on(want, *columns)
    assert on(ranking.top(df, ["g"], order, 3), *columns) == on(want.where("rank <= 3"), *columns)


def test_reports(spark):
    end = datetime(2017, 11, 26, 1, 5)
    counts = spark.createDataFrame([(5051027, end, 3, 2), (3493253, end, 4, 1), (1, end, 2, 3), (2, end, 1, 4)], "item_id bigint, window_end timestamp_ntz, view_count bigint, rank bigint")
    (row,) = ranking.hot_items_report(counts, 2).collect()
    rule = "=" * 36 + "\n"
    assert row.report == (
        rule + "TimeStamp: 1511658300000\n时间: 2017-11-26 01:05:00.0\n"
        "No1:  商品ID=3493253  浏览量=4  windowEnd=1511658300000\n"
        "No2:  商品ID=5051027  浏览量=3  windowEnd=1511658300000\n" + rule + "\n"
    )
    traffic = spark.createDataFrame([("/b", end, end, 1, 2), ("/a", end, end, 9, 1)], "url string, window_start timestamp_ntz, window_end timestamp_ntz, view_count bigint, rank bigint")
    lines = [r.line for r in ranking.traffic_report_lines(traffic.withColumn("n_rows", F.lit(2)), "n_rows").sort("line_no").collect()]
    assert lines == [rule.strip(), "时间: 2017-11-26 01:05:00.0", "No1:  URL=/a  流量=9", "No2:  URL=/b  流量=1", rule.strip()]


def kind(value):
    return F.col("kind") == value


def plain_next(df):
    row = F.struct("id", "kind", "ts")
    return df.withColumn("n", F.lead(row).over(Window.partitionBy("key").orderBy("ts", "id")))


@pytest.mark.parametrize("block", [None, "10 seconds", "1 minute", "1 day"])
def test_patterns_in_blocks(spark, block):
    df = spark.createDataFrame(make(5), SCHEMA)
    near = F.expr("n.ts - ts < interval 60 seconds")
    found = plain_next(df)
    got = patterns.pairs(df, "key", "ts", ["id"], kind("other"), kind("other"), "60 seconds", block)
    assert on(got, "id", "next.id") == on(found.where(kind("other") & (F.col("n.kind") == "other") & near), "id", "n.id")
    got = patterns.sequence_or_timeout(df, "key", "ts", ["id"], kind("create"), kind("pay"), "60 seconds", block)
    result = F.when(F.col("n").isNull() | ~near, "timeout").when(F.col("n.kind") == "pay", "success")
    want = found.where(kind("create")).withColumn("result", result).where("result is not null")
    assert on(got, "id", "result") == on(want, "id", "result")


def seconds(*rows):
    return [(i, *row[:-1], datetime(2019, 5, 21, 9, 27, 22) + timedelta(seconds=row[-1])) for i, row in enumerate(rows)]


def test_login_example(spark):
    # The login events that the job is known by.
    rows = seconds((1, "192.168.0.1", "fail", 0), (1, "192.168.0.2", "fail", 1), (1, "192.168.0.3", "fail", 2), (2, "192.168.10.10", "success", 3))
    df = spark.createDataFrame(rows, "id bigint, user_id bigint, ip string, kind string, ts timestamp_ntz")
    got = patterns.pairs(df, "user_id", "ts", ["id"], kind("fail"), kind("fail"), "2 seconds")
    assert on(got, "ip", "next.ip", "next.kind") == [
        ("192.168.0.1", "192.168.0.2", "fail"), ("192.168.0.2", "192.168.0.3", "fail"),
    ]
    apart = spark.createDataFrame(seconds((1, "a", "fail", 0), (1, "b", "fail", 2)), df.schema)
    assert patterns.pairs(apart, "user_id", "ts", ["id"], kind("fail"), kind("fail"), "2 seconds").count() == 0


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, "create", 0), (2, "create", 1), (2, "pay", 2)], [(1, "timeout"), (2, "success")]),
        ([(1, "create", 0), (1, "pay", 899)], [(1, "success")]),
        ([(1, "create", 0), (1, "pay", 900)], [(1, "timeout")]),
        ([(1, "create", 0), (1, "refund", 10), (1, "pay", 20)], []),
        ([(1, "create", 0), (1, "create", 10), (1, "pay", 20)], [(1, "success")]),
        ([(1, "create", 0)], [(1, "timeout")]),
        ([(1, "pay", 0)], []),
    ],
)
def test_order_examples(spark, rows, want):
    df = spark.createDataFrame(seconds(*rows), "id bigint, order_id bigint, kind string, ts timestamp_ntz")
    got = patterns.sequence_or_timeout(df, "order_id", "ts", ["id"], kind("create"), kind("pay"), "15 minutes")
    assert on(got, "order_id", "result") == want


def gate(spark, readings, switches, **options):
    base = datetime(2024, 1, 1)
    left = spark.createDataFrame([(k, base + timedelta(milliseconds=t), i) for i, (k, t) in enumerate(readings)], "id string, ts timestamp_ntz, n bigint")
    right = spark.createDataFrame([(k, base + timedelta(milliseconds=t), d) for k, t, d in switches], "id string, ts timestamp_ntz, duration_ms bigint")
    out = gating.gated(left, right, "id", **options)
    assert out.columns == left.columns
    return [n for (n,) in on(out, "n")]


def test_gate_bounds(spark):
    readings = [("a", -1), ("a", 0), ("a", 9_999), ("a", 10_000), ("b", 5_000)]
    assert gate(spark, readings, [("a", 0, 10_000)]) == [1, 2]
    assert gate(spark, readings, [("a", 0, 10_000), ("a", 5_000, 2_000)]) == [1, 2]
    assert gate(spark, readings, [("a", 0, 10_000), ("a", 5_000, 10_000)]) == [1, 2, 3]
    assert gate(spark, readings, [("a", 0, 2**63 - 1)]) == [1, 2, 3]
    assert gate(spark, readings, [("a", 0, 0), ("a", 0, -5)]) == []


@pytest.mark.parametrize(
    "options",
    [{}, {"block": "1 second"}, {"block": "1 minute"}, {"block": "365 days"}],
)
def test_gate_against_brute_force(spark, options):
    draw = random.Random(6)
    keys = ["hot", "hot", "a", "b", "c"]
    readings = [(draw.choice(keys), draw.randrange(60_000)) for _ in range(1500)]
    switches = [(draw.choice(keys[:-1]), draw.randrange(60_000), draw.randrange(3_000)) for _ in range(40)]
    want = [
        i for i, (k, t) in enumerate(readings) if any(s == k and at <= t < at + d for s, at, d in switches)
    ]
    assert gate(spark, readings, switches, **options) == want


@pytest.mark.parametrize("often", [0, 3, 1_000])
def test_only_frequent_words_are_counted_by_block(spark, monkeypatch, often):
    monkeypatch.setattr(words, "OFTEN", often)
    monkeypatch.setattr(words, "FREQUENT", 2)
    rows = [(at, word) for at in range(60) for word in ["the", "of" if at % 3 else "a", f"w{at}", None]]
    df = spark.createDataFrame(rows, "at long, word string").repartition(5)
    assert words.frequent(df) == (["the", "of"] if often < 40 else [])
    got = words.running_counts(df, ("at",), F.col("at"), (4, 3))
    seen, want = {}, []
    for at, word in rows:
        if word is not None:
            seen[word] = seen.get(word, 0) + 1
            want.append((word, at, seen[word]))
    assert got.columns == ["word", "at", "running"] and sorted(map(tuple, got.collect())) == sorted(want)
    text = got._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert ("SortMergeJoin" in text) == (often < 40)  # no blocks, so no totals to join, where no word is frequent
