"""Streams must give what the batch operators give, once the watermark has passed."""

import random
from datetime import datetime, timedelta

from conftest import on
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import gating, patterns, ranking, windows, words
from tidemark.sinks import streams
from tidemark.streaming import events, gating as stream_gating, patterns as stream_patterns, words as stream_words
from tidemark.streaming.ordered import InOrder

START = datetime(2024, 1, 1)
END = datetime(2100, 1, 1)
EVENT = "id bigint, key bigint, kind string, ts timestamp_ntz"


def event_rows(seed, n=300, keys=5, span=3600, kinds=("create", "pay", "other")):
    """Rows in ascending time with ties in time, one key holding a third of them."""
    draw = random.Random(seed)
    seconds = sorted(draw.randrange(span) for _ in range(n))
    return [
        (i, 0 if draw.random() < 0.34 else draw.randrange(1, keys), draw.choice(kinds), START + timedelta(seconds=s))
        for i, s in enumerate(seconds)
    ]


def batches(rows, n, end=None):
    """The rows in `n` parts, then rows far in the future: the first lets everything before it pass,
    the second starts a micro-batch in which that happens."""
    size = -(-len(rows) // n)
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    return parts + ([[end], [end]] if end else [])


def test_running_counts_per_occurrence(spark, replay, drain):
    lines = [("a b a",), ("b  a",), ("c",), ("a a",)]
    schema = "value string"
    stream = words.nonempty(words.words(replay(batches(lines, 4), schema)))
    got = drain(stream_words.running_counts(stream))
    assert sorted(got) == [("a", i) for i in range(1, 6)] + [("b", 1), ("b", 2), ("c", 1)]


def test_word_counts_update(spark, replay, drain):
    stream = words.word_counts(words.nonempty(words.words(replay(batches([("a b a",), ("b a",)], 2), "value string"))))
    got = drain(stream, "update")
    assert sorted(got) == [("a", 2), ("a", 3), ("b", 1), ("b", 2)]


def test_sliding_counts_and_top(spark, replay, tmp_path):
    rows = event_rows(1)
    batch = spark.createDataFrame(rows, EVENT)
    order = [F.desc("view_count"), F.asc("key")]
    counts = windows.sliding_counts(batch, ["key"], "ts", "10 minutes", "1 minute")
    want = on(ranking.top(counts, ["window_end"], order, 3), F.col("window_end").cast("timestamp"), "key", "view_count", "rank")

    stream = events.event_time(replay(batches(rows, 4, (-1, -1, "end", END)), EVENT))
    stream_counts = windows.window_counts(stream, ["key"], "ts", "10 minutes", "1 minute")
    for rank_windows, extra in ((streams.top_of_windows, (3,)), (streams.ranks_of_windows, ())):
        got = []

        def write(frame, number):
            got.extend(on(frame, "window_end", "key", "view_count", "rank"))

        query = rank_windows(
            stream_counts, ["window_end"], order, *extra, write, str(tmp_path / rank_windows.__name__), availableNow=True
        )
        query.awaitTermination(300)
        assert query.exception() is None
        assert sorted(row for row in got if row[3] <= 3) == want


def test_means(spark, replay, drain):
    rows = event_rows(2)
    batch = windows.window_means(spark.createDataFrame(rows, EVENT), ["key"], "ts", F.col("id"), "1 minute", "mean")
    stream = events.event_time(replay(batches(rows, 3, (-1, -1, "end", END)), EVENT), delay=events.SENSOR_DISORDER)
    got = drain(windows.window_means(stream, ["key"], "ts", F.col("id"), "1 minute", "mean"))
    assert sorted(got) == on(batch, "key", F.col("ts").cast("timestamp"), "mean")


def test_late_rows_are_dropped_per_window(spark, replay, drain):
    def row(i, second):
        return (i, 1, "x", START + timedelta(seconds=second))

    # A micro-batch is checked against the watermark the one before it started with.
    parts = [[row(0, 0), row(1, 100)], [row(4, 101)], [row(2, 55), row(3, 70)], [(-1, -1, "end", END)]]
    stream = events.event_time(replay(parts, EVENT))
    got = drain(windows.window_counts(stream, ["key"], "ts", "60 seconds", "60 seconds"))
    assert [(r[1], r[3]) for r in sorted(got)] == [(START, 1), (START + timedelta(seconds=60), 3)]


def pattern(kind):
    return F.col("kind") == kind


def test_sequence_or_timeout(spark, replay, drain):
    rows = event_rows(3)
    batch = patterns.sequence_or_timeout(
        spark.createDataFrame(rows, EVENT), "key", "ts", ["id"], pattern("create"), pattern("pay"), "60 seconds"
    )
    stream = events.event_time(replay(batches(rows, 5, (-1, -1, "end", END)), EVENT), delay=events.ASCENDING_TIES)
    got = drain(
        stream_patterns.sequence_or_timeout(stream, "key", "ts", ["id"], pattern("create"), pattern("pay"), "60 seconds")
        .select("id", "key", "ts", "result")
    )
    want = on(batch, "id", "key", F.col("ts").cast("timestamp"), "result")
    assert {r[3] for r in want} == {"success", "timeout"}
    assert sorted(got) == want


def test_pairs_under_disorder(spark, replay, drain):
    rows = event_rows(4)
    batch = patterns.pairs(
        spark.createDataFrame(rows, EVENT), "key", "ts", ["id"], pattern("other"), pattern("other"), "60 seconds"
    )
    draw = random.Random(4)
    mixed = sorted(rows, key=lambda r: r[3] + timedelta(seconds=draw.uniform(0, 50)))
    stream = events.event_time(replay(batches(mixed, 6, (-1, -1, "end", END)), EVENT), delay="60 seconds")
    got = drain(
        stream_patterns.pairs(stream, "key", "ts", ["id"], pattern("other"), pattern("other"), "60 seconds")
        .select("id", "next.id", "next.kind")
    )
    assert sorted(got) == on(batch, "id", "next.id", "next.kind")


def test_gate_by_event_time(spark, replay, drain):
    rows = event_rows(5, kinds=("reading", "reading", "switch"))
    schema = EVENT + ", duration_ms bigint"
    draw = random.Random(5)
    rows = [(*row, draw.randrange(0, 120_000)) for row in rows]

    def sides(df):
        readings = df.where("kind != 'switch'").select("id", "key", "ts")
        return readings, df.where("kind != 'reading'").select("key", "ts", "duration_ms")

    want = on(gating.gated(*sides(spark.createDataFrame(rows, schema)), "key"), "id", "key")
    stream = replay(batches(rows, 5, (-1, -1, "end", END, 0)), schema)
    stream = events.event_time(stream, delay=events.ASCENDING_TIES)
    got = drain(stream_gating.gated(*sides(stream), "key").select("id", "key"))
    assert 0 < len(want) < len(rows) / 2
    assert sorted(got) == want


def test_gate_by_clock(spark, replay, watch):
    schema = "kind string, key string, n bigint"
    parts = [[("reading", "a", 1)], [("switch", "a", 600_000)], [("reading", "a", 2), ("reading", "b", 3)]]
    stream = replay(parts, schema)
    readings = stream.where("kind = 'reading'").select("key", "n")
    switches = stream.where("kind = 'switch'").select("key", F.col("n").alias("duration_ms"))
    assert watch(stream_gating.gated_by_clock(readings, switches, "key"), 1) == [("a", 2)]


class Value:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Map:
    """Map state that counts how many rows it has handed out."""

    def __init__(self):
        self.parts, self.read = {}, 0

    def getValue(self, key):
        self.read += len(self.parts[key][0])
        return self.parts[key]

    def updateValue(self, key, value):
        self.parts[key] = value

    def removeKey(self, key):
        del self.parts[key]


class Held:
    """The state of a key, for running a processor by hand."""

    def __init__(self):
        self.timers, self.values, self.map = set(), {}, Map()

    def getValueState(self, name, schema):
        return self.values.setdefault(name, Value())

    def getMapState(self, name, key, value):
        return self.map

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def fire(self, processor, now):
        """What is put out when the timers up to `now` fire."""
        out = []
        for at in sorted(at for at in self.timers if at <= now):
            out += processor.handleExpiredTimer(("a",), Clock(now), None)
            self.timers.remove(at)
        return out


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    getCurrentWatermarkInMs = getCurrentProcessingTimeInMs


def test_clock_gate_extends_and_expires():
    state, gate = Held(), stream_gating.ProcessingTimeGate("key", ["n"])
    gate.init(state)

    def at(now, *rows):
        rows = [Row(key="a", _kind=kind, _duration=value, n=value) for kind, value in rows]
        return [r.n for r in gate.handleInputRows(("a",), iter(rows), Clock(now))]

    switch, reading = stream_gating.SWITCH, stream_gating.READING
    assert at(1000, (reading, 1)) == []
    assert at(1000, (switch, 10), (reading, 2)) == [2]
    assert state.timers == {1010}
    assert at(1005, (switch, 2), (reading, 3)) == [3]
    assert state.timers == {1010}
    for now in range(1005, 1501, 5):  # many extensions, one live timer
        assert at(now, (switch, 10)) == []
        assert state.timers == {now + 10}
    assert state.fire(gate, 1509) == []
    assert at(1509, (reading, 4)) == [4]
    assert at(1510, (reading, 5)) == []
    state.fire(gate, 1511)
    assert state.timers == set() and state.values["alarm"].value is None


HELD_ROWS = T.StructType([T.StructField("_at", T.LongType()), T.StructField("n", T.LongType())])


class Handed(InOrder):
    """Puts rows out as they are handed on."""

    def ready(self, key, rows, passed):
        for row in rows:
            assert row["_at"] < passed
            yield row["n"]


def test_held_rows_are_read_once():
    """20,000 rows held over 2,000 buckets while the watermark goes on 500 times: each is read once, in order."""
    state, keeper = Held(), Handed(HELD_ROWS, ("n",))
    keeper.init(state)
    draw, out, n = random.Random(7), [], 0
    for step in range(500):
        rows = []
        for _ in range(40):
            rows.append(Row(_at=step * 1_000_000 + draw.randrange(2_000_000_000), n=n))
            n += 1
        list(keeper.handleInputRows(("a",), iter(rows), Clock(0)))
        assert len(state.timers) == 1
        out += state.fire(keeper, step * 1000 - 1)
    held = sum(len(part[0]) for part in state.map.parts.values())
    assert len(out) + held == n and held > 10_000 and state.map.read == len(out)
    out += state.fire(keeper, 10_000_000)
    assert len(out) == len(set(out)) == n and state.map.read == n
    assert not state.map.parts and not state.timers and state.values["pending"].value is None


def test_parts_of_a_bucket_come_in_order():
    state, keeper = Held(), Handed(HELD_ROWS, ("n",))
    keeper.init(state)
    rows = [Row(_at=5_000_000 + k % 7, n=k) for k in range(2500)]  # three parts of one bucket
    list(keeper.handleInputRows(("a",), iter(rows), Clock(0)))
    assert len(state.map.parts) == 3 and state.timers == {6000}
    assert state.fire(keeper, 5999) == []
    assert state.fire(keeper, 6000) == [r.n for r in sorted(rows, key=lambda r: (r._at, r.n))]


def test_outputs_of_one_pass(spark, replay, tmp_path):
    stream = words.words(replay(batches([("to be or not",), ("wonder question",)], 2), "value string"))
    got = {"counted": [], "rejected": []}

    def into(name):
        return lambda frame, number: got[name].extend(r.word for r in frame.collect())

    outputs = {"counted": (words.short(), into("counted")), "rejected": (~words.short(), into("rejected"))}
    query = streams.to_outputs(stream, outputs, str(tmp_path / "outputs"), availableNow=True)
    query.awaitTermination(300)
    assert query.exception() is None
    assert sorted(got["counted"]) == ["be", "not", "or", "to"]
    assert sorted(got["rejected"]) == ["question", "wonder"]


def test_files_and_console(spark, replay, tmp_path):
    stream = replay([[("a",)], [("b",)]], "value string")
    out, check = str(tmp_path / "files"), str(tmp_path / "check")
    for _ in range(2):
        streams.to_parquet(stream, out, check, availableNow=True).awaitTermination(300)
    assert on(spark.read.parquet(out), "value") == [("a",), ("b",)]
    streams.to_console(stream, "word", availableNow=True).awaitTermination(300)
