"""Bounded streams and what is finished from their checkpoints: together what the batch operators give."""

from datetime import datetime, timedelta

import pytest
from conftest import on
from pyspark.sql import functions as F
from test_streaming import EVENT, batches, event_rows, pattern

from tidemark import schemas
from tidemark.plans.sensors import GeometricMean, fold_mean
from tidemark.operators import aggregates, gating, patterns, ranking, windows
from tidemark.sinks import streams
from tidemark.streaming import aggregates as stream_aggregates
from tidemark.streaming import events, flush, jobs
from tidemark.streaming import gating as stream_gating
from tidemark.streaming import patterns as stream_patterns
from tidemark.streaming import ranking as stream_ranking


@pytest.fixture
def ended(spark, tmp_path):
    """Rows that a stream puts out over its files, and its checkpoint."""

    def run(stream, name):
        checkpoint, rows = str(tmp_path / f"{name}-state"), []
        query = streams.each_batch(stream, lambda batch, number: rows.extend(tuple(r) for r in batch.collect()), checkpoint, availableNow=True)
        query.awaitTermination(300)
        assert query.exception() is None
        return rows, checkpoint

    return run


def test_open_windows(spark, replay, ended):
    rows = event_rows(11)
    batch = spark.createDataFrame(rows, EVENT)
    end = F.col("window_end").cast("timestamp")
    stream = windows.window_counts(events.event_time(replay(batches(rows, 4), EVENT)), ["key"], "ts", "10 minutes", "1 minute")
    got, checkpoint = ended(stream, "counts")
    left = on(flush.window_counts(spark, checkpoint, ["key"]), "key", "window_end", "view_count")
    want = on(windows.sliding_counts(batch, ["key"], "ts", "10 minutes", "1 minute"), "key", end, "view_count")
    assert got and left and sorted([(r[0], r[2], r[3]) for r in got] + left) == want

    means = windows.window_means(events.event_time(replay(batches(rows, 4), EVENT), delay="5 seconds"), ["key"], "ts", F.col("id"), "1 minute", "mean")
    got, checkpoint = ended(means, "means")
    left = on(flush.window_means(spark, checkpoint, ["key"], "mean"), "key", "ts", "mean")
    want = on(windows.window_means(batch, ["key"], "ts", F.col("id"), "1 minute", "mean"), "key", F.col("ts").cast("timestamp"), "mean")
    assert got and left and sorted(got + left) == want


def test_waiting_events(spark, replay, ended):
    rows = event_rows(12)
    batch = spark.createDataFrame(rows, EVENT)
    source = replay(batches(rows, 5), EVENT)
    first, second = pattern("create"), pattern("pay")
    for delay, name in (("1 millisecond", "ties"), ("10 minutes", "long")):
        timed = events.event_time(source, delay=delay)
        got, checkpoint = ended(stream_patterns.sequence_or_timeout(timed, "key", "ts", ["id"], first, second, "60 seconds").select("id", "result"), name)
        left = on(flush.sequence_or_timeout(source, checkpoint, "key", "ts", ["id"], "60 seconds"), "id", "result")
        want = on(patterns.sequence_or_timeout(batch, "key", "ts", ["id"], first, second, "60 seconds"), "id", "result")
        assert got and (left or name == "ties") and sorted(got + left) == want
    timed = events.event_time(source, delay="10 minutes")
    other = pattern("other")
    got, checkpoint = ended(stream_patterns.pairs(timed, "key", "ts", ["id"], other, other, "60 seconds").select("id", "next.id"), "pairs")
    left = on(flush.pairs(source, checkpoint, "key", "ts", ["id"], "60 seconds"), "id", "next.id")
    assert left and sorted(got + left) == on(patterns.pairs(batch, "key", "ts", ["id"], other, other, "60 seconds"), "id", "next.id")


def test_held_readings(spark, replay, ended):
    schema = EVENT + ", duration_ms bigint"
    rows = [(*row, 37_000 * (row[0] % 7)) for row in event_rows(13, kinds=("reading", "reading", "switch"))]

    def sides(df):
        return df.where("kind != 'switch'").select("id", "key", "ts"), df.where("kind != 'reading'").select("key", "ts", "duration_ms")

    timed = events.event_time(replay(batches(rows, 5), schema), delay="5 minutes")
    got, checkpoint = ended(stream_gating.gated(*sides(timed), "key").select("id"), "gate")
    left = on(flush.gated(sides(timed)[0], checkpoint, "key"), "id")
    assert got and left and sorted(got + left) == on(gating.gated(*sides(spark.createDataFrame(rows, schema)), "key"), "id")


def test_order_results_without_end_rows(replay, ended, spark):
    base = datetime(2019, 5, 21, 9, 27, 22)
    rows = [(1, "create", base), (2, "create", base + timedelta(seconds=1)), (2, "pay", base + timedelta(seconds=2))]
    source = replay([rows], schemas.ORDER_EVENT)
    got, checkpoint = ended(jobs.order_results(source), "orders")
    assert sorted(got + on(jobs.order_results_left(source, checkpoint), "order_id", "result")) == [(1, "timeout"), (2, "success")]


def test_to_end_twice(spark, replay, tmp_path):
    """The rest is one more batch: run again, every row is there once."""
    rows = event_rows(14)
    stream = windows.window_counts(events.event_time(replay(batches(rows, 3), EVENT)), ["key"], "ts", "10 minutes", "10 minutes")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        flush.to_end(stream, lambda: flush.window_counts(spark, checkpoint, ["key"]), streams.parquet_batches(out), checkpoint)
    got = on(streams.committed(spark, out, stream.schema), "key", "window_end", "view_count")
    batch = windows.window_counts(spark.createDataFrame(rows, EVENT).withColumn("ts", F.col("ts").cast("timestamp")), ["key"], "ts", "10 minutes", "10 minutes")
    assert got == on(batch, "key", "window_end", "view_count")


def behaviour(rows):
    return [(f"{i},{key},1,pv,{int((ts - datetime(1970, 1, 1)).total_seconds())}",) for i, key, _, ts in rows]


def test_chained_reports(spark, replay, ended):
    """Counts, first rows by shard and by window, and report text in one query; with the rest as in batch."""
    rows = event_rows(15, keys=40, span=20_000)
    got, checkpoint = ended(jobs.hot_items_reports(replay(batches(behaviour(rows), 5), schemas.LINE)), "reports")
    left = on(jobs.hot_items_reports_left(spark, checkpoint), "window_end", "report")
    batch = spark.createDataFrame(rows, EVENT).withColumnRenamed("key", "item_id")
    counts = windows.sliding_counts(batch, ["item_id"], "ts", jobs.ITEM_SIZE, jobs.ITEM_SLIDE)
    top = ranking.top(counts, ["window_end"], [F.desc("view_count"), F.asc("item_id")], 3)
    want = on(ranking.hot_items_report(top, 3), F.col("window_end").cast("timestamp"), "report")
    assert len(got) > 20 and left and sorted(got + left) == want
    held = flush.state(spark, checkpoint, "best", flush.PROCESSOR)
    assert held.count() == 0 and flush.state(spark, checkpoint, "best", flush.PROCESSOR, 1).count() == 0


def test_top_rows_by_shards(spark, replay, ended):
    """Many keys in a window, ties in the counts: the same rows with one shard and with many."""
    rows = [(i, i % 97, "x", datetime(2024, 1, 1) + timedelta(seconds=i)) for i in range(400)]
    want = None
    for shards in (1, 5):
        timed = events.event_time(replay(batches(rows, 3, (-1, -1, "end", datetime(2100, 1, 1))), EVENT))
        counts = stream_ranking.timed_counts(timed, ["key"], "ts", "100 seconds", "100 seconds")
        got, _ = ended(stream_ranking.top_rows(counts, "key", 4, shards=shards), f"top{shards}")
        found = sorted((end, [tuple(r) for r in part]) for end, part in got)
        assert want is None or found == want
        want = found
    assert [part for _, part in want][0] == [(1, 0, 2), (2, 1, 2), (3, 2, 2), (4, 3, 1)]


def test_url_report_lines(spark, replay, tmp_path):
    log = "83.149.9.216 - - 17/05/2015:10:{:02}:{:02} +0000 GET {}"
    visits = [(log.format(m, s, f"/{m * s % 5}"),) for m in range(0, 40, 7) for s in (3, 4, 30)]
    got, checkpoint = [], str(tmp_path / "urls")

    def write(batch, number):
        got.extend(on(batch, "window_start", "line_no", "line"))

    jobs.url_traffic_reports(replay(batches(visits, 3), schemas.LINE), write, checkpoint, availableNow=True).awaitTermination(300)
    left = on(jobs.url_traffic_reports_left(spark, checkpoint), "window_start", "line_no", "line")
    batch = jobs.records.parse_access_log(spark.createDataFrame(visits, schemas.LINE))
    counts = windows.sliding_counts(batch, ["url"], "ts", jobs.URL_SIZE, jobs.URL_SLIDE)
    ranked = ranking.numbered(counts, ["window_start"], [F.desc("view_count"), F.asc("url")], total="n_rows")
    want = on(ranking.traffic_report_lines(ranked, "n_rows"), F.col("window_start").cast("timestamp"), "line_no", "line")
    assert got and left and sorted(got + left) == want


TEMPERATURE = "id bigint, key bigint, ts timestamp_ntz, temperature double"


def readings(seed):
    """Rows of five sensors, up to 4 seconds behind the latest time, one sensor with a third of them."""
    mixed = sorted(event_rows(seed, n=2500, span=900), key=lambda r: r[3] + timedelta(seconds=(r[0] * 7919) % 4))
    return [(i, key, ts, 0.5 + i % 11) for i, key, _, ts in mixed]


def test_own_aggregate_of_windows(spark, replay, ended):
    """A caller's own aggregate over a stream's windows, tumbling and sliding, with the rest as in batch."""
    rows = readings(16)
    batch = spark.createDataFrame(rows, TEMPERATURE)
    for slide, name in ((None, "tumbling"), ("30 seconds", "sliding")):
        timed = events.event_time(replay(batches(rows, 5), TEMPERATURE), delay=events.SENSOR_DISORDER)
        mean = GeometricMean("temperature")
        got, checkpoint = ended(stream_aggregates.aggregated(timed, ["key"], "ts", "1 minute", mean, slide), name)
        left = on(flush.aggregates(spark, checkpoint, ["key"], mean), "key", "window_start", "window_end", "mean")
        window = F.window("ts", "1 minute", slide)
        given = batch.withColumn("w", window).select("*", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")).drop("w")
        want = on(aggregates.aggregated(given, ["key", "window_start", "window_end"], mean), "key", "window_start", "window_end", "mean")
        assert got and left and sorted(got + left) == [(*row[:3], pytest.approx(row[3])) for row in want]


def test_function_of_whole_windows(spark, replay, ended):
    """The whole-window function on a stream: several batches for a window of over 1,000 rows."""
    rows = readings(17)
    timed = events.event_time(replay(batches(rows, 4), TEMPERATURE), delay=events.SENSOR_DISORDER)
    stream = stream_aggregates.by_window(timed, ["key"], "ts", "10 minutes", fold_mean, "temperature double")
    got, checkpoint = ended(stream, "function")
    left = on(flush.by_window(timed, checkpoint, ["key"], fold_mean, "temperature double"), "key", "window_start", "window_end", "temperature")
    batch = aggregates.by_window(spark.createDataFrame(rows, TEMPERATURE), ["key"], "ts", "10 minutes", fold_mean, "temperature double")
    times_ = [F.col(c).cast("timestamp") for c in ("window_start", "window_end")]
    want = on(batch, "key", *times_, "temperature")
    assert got and left and sorted(got + left) == [(*row[:3], pytest.approx(row[3])) for row in want]


def test_a_row_is_late_when_its_window_is_over(replay, ended):
    def row(i, second, value):
        return (i, 1, datetime(2024, 1, 1) + timedelta(seconds=second), value)

    # Behind the watermark but in an open window (70), and in one that is over (30).
    parts = [[row(0, 0, 1.0), row(1, 100, 2.0)], [row(2, 101, 2.0)], [row(3, 70, 2.0), row(4, 30, 9.0)], [row(5, 400, 1.0)], [row(6, 401, 1.0)]]
    timed = events.event_time(replay(parts, TEMPERATURE))
    got, _ = ended(stream_aggregates.by_window(timed, ["key"], "ts", "1 minute", fold_mean, "temperature double"), "late")
    assert [r[3] for r in sorted(got)] == [1.0, 2.0]
