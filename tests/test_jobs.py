"""The streaming jobs from source to sink, on the record shapes they are made for."""

from datetime import datetime, timedelta

from conftest import on

from tidemark import schemas
from tidemark.streaming import jobs

BASE = datetime(2019, 5, 21, 9, 27, 22)
END = datetime(2100, 1, 1)


def second(n):
    return BASE + timedelta(seconds=n)


def finished(query):
    query.awaitTermination(300)
    assert query.exception() is None


def test_login_failures(replay, drain):
    # The login and order events that the jobs are known by.
    rows = [(1, f"192.168.0.{i}", "fail", second(i)) for i in (1, 2, 3)] + [(2, "192.168.10.10", "success", second(4))]
    end = [(-1, "", "end", END)]
    got = drain(jobs.login_failures(replay([rows[:2], rows[2:], end, end], schemas.LOGIN_EVENT)))
    assert sorted(got) == [("192.168.0.1", "192.168.0.2", "fail"), ("192.168.0.2", "192.168.0.3", "fail")]


def test_order_results(replay, drain):
    rows = [(1, "create", second(0)), (2, "create", second(1)), (2, "pay", second(2))]
    end = [(-1, "end", END)]
    got = drain(jobs.order_results(replay([rows, end, end], schemas.ORDER_EVENT)))
    assert sorted(got) == [(1, "timeout"), (2, "success")]


def test_routed_words(replay, tmp_path):
    out = {"counted": [], "rejected": []}

    def into(name):
        return lambda batch, number: out[name].extend(tuple(r) for r in batch.collect())

    lines = replay([[("to wonder to",), ("  ",)], [("to question",)]], schemas.LINE)
    finished(jobs.routed_words(lines, into("counted"), into("rejected"), str(tmp_path / "c"), availableNow=True))
    assert sorted(out["counted"]) == [("to", 1), ("to", 2), ("to", 3)]
    assert sorted(out["rejected"]) == [("question",), ("wonder",)]


def test_hot_items_and_url_traffic(replay, tmp_path):
    views = [(f"{u},{item},1,{kind},{1511658000 + u}",) for u, item, kind in
             ((1, 7, "pv"), (2, 7, "pv"), (3, 8, "pv"), (4, 8, "buy"))]
    end = [("0,0,0,pv,4102444800",)]
    got = []

    def write(batch, number):
        got.extend(on(batch, "window_end", batch.columns[0], "view_count", "rank"))

    lines = replay([views, end, end], schemas.LINE)
    finished(jobs.hot_items(lines, write, str(tmp_path / "items"), availableNow=True))
    first = datetime(2017, 11, 26, 1, 5)
    assert len(got) == 24 and sorted(got)[:2] == [(first, 7, 2, 1), (first, 8, 1, 2)]

    log = "83.149.9.216 - - {} +0000 GET {}"
    visits = [(log.format("17/05/2015:10:05:0" + s, url),) for s, url in (("3", "/a"), ("4", "/b"), ("4", "/b"))]
    end = [(log.format("01/01/2100:00:00:00", "/end"),)]
    got.clear()
    lines = replay([visits, end, end], schemas.LINE)
    finished(jobs.url_traffic(lines, write, str(tmp_path / "urls"), availableNow=True))
    assert len(got) == 240 and {row[1:] for row in got} == {("/b", 2, 1), ("/a", 1, 2)}


def test_sensor_means(replay, drain):
    """Rows up to 5 seconds behind the latest count; behind the watermark they are late for their window."""
    rows = [
        [("s1", second(0.9), 212.0), ("s2", second(0.5), 50.0)], [("s2", second(5), 32.0)],
        [("s1", second(0.1), 32.0)], [("s2", second(6.5), 212.0)], [("s2", second(6.6), 212.0)],
        [("s1", second(0.2), 1000.0), ("s2", second(5.1), 212.0)],
    ]
    end = [("end", END, 0.0)]
    got = drain(jobs.sensor_means(replay([*rows, end], schemas.SENSOR_READING)))
    assert sorted(got) == [("s1", second(1), 50.0), ("s2", second(1), 10.0), ("s2", second(6), 50.0), ("s2", second(7), 100.0)]


def test_forwarded_readings(replay, watch):
    schema = "id string, ts timestamp_ntz, temperature double, duration_ms bigint"
    rows = [[("s1", second(0), 1.0, None)], [("s1", None, None, 600_000)], [("s1", second(1), 2.0, None), ("s2", second(1), 3.0, None)]]
    stream = replay(rows, schema)
    readings = stream.where("duration_ms is null").select("id", "ts", "temperature")
    switches = stream.where("duration_ms is not null").select("id", "duration_ms")
    assert watch(jobs.forwarded_readings(readings, switches), 1) == [("SensorReading(s1,1558430843000,2.0) 05-21_09:27:23",)]


def test_totals_and_clean_lines(replay, drain):
    lines = replay([[("a  b",)], [("",), ("a",)]], schemas.LINE)
    assert sorted(drain(jobs.word_totals(lines), "update")) == [("a", 1), ("a", 2), ("b", 1)]
    assert sorted(drain(jobs.clean_lines(lines))) == [("a",), ("a  b",)]
