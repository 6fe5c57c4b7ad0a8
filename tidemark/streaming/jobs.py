"""The jobs as streams, from lines or records to results. Each takes any streaming source: files,
a socket, a topic. What is left of a bounded one is finished by the job's `_left`, see `flush`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions import readings as reading
from tidemark.operators import ranking, windows, words
from tidemark.sinks import streams
from tidemark.sources import lines as line_source
from tidemark.sources import records
from tidemark.streaming import events, flush, gating, patterns
from tidemark.streaming import ranking as stream_ranking
from tidemark.streaming import words as counting

# Windows, slides, list length and bounds of the jobs.
ITEM_SIZE, ITEM_SLIDE, ITEM_TOP = "60 minutes", "5 minutes", 3
URL_SIZE, URL_SLIDE = "10 minutes", "5 seconds"
SENSOR_SIZE = "1 second"
LOGIN_BOUND, ORDER_BOUND = "2 seconds", "15 minutes"
PAGE_VIEW, FAIL, CREATE, PAY = "pv", "fail", "create", "pay"


def word_totals(lines: DataFrame) -> DataFrame:
    """Totals per word, for update mode: each micro-batch puts out the words it changed."""
    return words.word_counts(words.nonempty(words.words(lines)))


def routed_words(lines: DataFrame, counted: streams.Write, rejected: streams.Write, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Short words with their count so far to one output, longer words to another, in one pass."""
    all_words = words.words(line_source.without_blank(lines))
    routed = counting.running_counts(all_words, words.short())
    outputs = {
        "counted": (words.short(), counted),
        "rejected": (~words.short(), lambda batch, number: rejected(batch.select("word"), number)),
    }
    return streams.to_outputs(routed, outputs, checkpoint, **trigger)


def hot_items(lines: DataFrame, write: streams.Write, checkpoint: str, **trigger: object) -> StreamingQuery:
    """The most viewed items of every sliding window, from user behaviour lines."""
    views = events.event_time(records.parse_behavior(lines).where(F.col("behavior") == PAGE_VIEW))
    counts = windows.window_counts(views, ["item_id"], "ts", ITEM_SIZE, ITEM_SLIDE)
    order = [F.desc("view_count"), F.asc("item_id")]
    return streams.top_of_windows(counts, ["window_end"], order, ITEM_TOP, write, checkpoint, **trigger)


def hot_items_reports(lines: DataFrame) -> DataFrame:
    """The report text of every sliding window's most viewed items: `window_end, report`, without a batch sink."""
    views = events.event_time(records.parse_behavior(lines).where(F.col("behavior") == PAGE_VIEW))
    counts = stream_ranking.timed_counts(views, ["item_id"], "ts", ITEM_SIZE, ITEM_SLIDE)
    top = stream_ranking.top_rows(counts, "item_id", ITEM_TOP)
    return top.select("window_end", ranking.hot_items_text(F.col("window_end"), F.col("rows")).alias("report"))


def hot_items_reports_left(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The reports of windows that `hot_items_reports` left open; further operators hold nothing of these."""
    counts = flush.window_counts(spark, checkpoint, ["item_id"])
    top = ranking.top(counts, ["window_end"], [F.desc("view_count"), F.asc("item_id")], ITEM_TOP)
    return ranking.hot_items_report(top, ITEM_TOP)


def _url_order() -> list[Column]:
    return [F.desc("view_count"), F.asc("url")]


def _url_counts(lines: DataFrame) -> DataFrame:
    visits = events.event_time(records.parse_access_log(lines))
    return windows.window_counts(visits, ["url"], "ts", URL_SIZE, URL_SLIDE)


def url_traffic(lines: DataFrame, write: streams.Write, checkpoint: str, **trigger: object) -> StreamingQuery:
    """All URLs of every sliding window, ranked by visits, from access log lines."""
    return streams.ranks_of_windows(_url_counts(lines), ["window_start"], _url_order(), write, checkpoint, **trigger)


def url_traffic_reports(lines: DataFrame, write: streams.Write, checkpoint: str, **trigger: object) -> StreamingQuery:
    """The report of `url_traffic` as lines: `window_start, line_no, line`; a window of any size stays rows."""

    def write_lines(batch: DataFrame, number: int) -> None:
        write(ranking.traffic_report_lines(batch, "n_rows"), number)

    return streams.ranks_of_windows(
        _url_counts(lines), ["window_start"], _url_order(), write_lines, checkpoint, total="n_rows", **trigger
    )


def url_traffic_reports_left(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The report lines of windows left open."""
    counts = flush.window_counts(spark, checkpoint, ["url"])
    return ranking.traffic_report_lines(ranking.numbered(counts, ["window_start"], _url_order(), total="n_rows"), "n_rows")


def login_failures(logins: DataFrame) -> DataFrame:
    """Two failures in a row of one user: the addresses of both. `user_id, ip, event_type, ts`."""
    failed = F.col("event_type") == FAIL
    timed = events.event_time(logins, delay=events.ASCENDING_TIES)
    return _login_pairs(patterns.pairs(timed, "user_id", "ts", [], failed, failed, LOGIN_BOUND))


def login_failures_left(logins: DataFrame, checkpoint: str) -> DataFrame:
    return _login_pairs(flush.pairs(logins, checkpoint, "user_id", "ts", [], LOGIN_BOUND))


def _login_pairs(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("ip").alias("first_ip"), F.col("next.ip").alias("second_ip"), F.col("next.event_type").alias("event_type")
    )


def order_results(orders: DataFrame) -> DataFrame:
    """Orders paid in time and orders timed out: `order_id, result`. `order_id, event_type, ts`."""
    created, paid = F.col("event_type") == CREATE, F.col("event_type") == PAY
    timed = events.event_time(orders, delay=events.ASCENDING_TIES)
    return patterns.sequence_or_timeout(timed, "order_id", "ts", [], created, paid, ORDER_BOUND).select("order_id", "result")


def order_results_left(orders: DataFrame, checkpoint: str) -> DataFrame:
    """The results that only the end of the input decides: an order without a successor times out."""
    return flush.sequence_or_timeout(orders, checkpoint, "order_id", "ts", [], ORDER_BOUND).select("order_id", "result")


def sensor_means(readings: DataFrame) -> DataFrame:
    """The mean temperature in Celsius per sensor and second, stamped with the second's end."""
    timed = events.event_time(readings, delay=events.SENSOR_DISORDER)
    return windows.window_means(timed, ["id"], "ts", reading.celsius(F.col("temperature")), SENSOR_SIZE, "temperature")


def sensor_means_left(spark: SparkSession, checkpoint: str) -> DataFrame:
    return flush.window_means(spark, checkpoint, ["id"], "temperature")


def forwarded_readings(readings: DataFrame, switches: DataFrame) -> DataFrame:
    """Readings that arrive while their sensor is switched on, as text."""
    passing = gating.gated_by_clock(readings, switches, "id")
    return passing.select(reading.reading_text(F.col("id"), F.col("ts"), F.col("temperature")).alias("reading"))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Non-blank lines, ready to be published to a topic."""
    return line_source.without_blank(line_source.split_records(lines))
