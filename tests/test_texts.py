from conftest import on
from pyspark.sql import functions as F

from tidemark.functions import readings, text, times
from tidemark.operators import routing, words
from tidemark.sources import lines


def rows(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")


def java_split(line, separator):
    """Split that drops trailing empties and gives an unsplit line back whole."""
    if separator not in line:
        return [line]
    parts = line.split(separator)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_tokens_follow_the_split_rule(spark):
    values = ["", "   ", "a b ", "  a", "a  b", "a", " ", "a\tb c", "é ü  ", "x  y   "]
    df = rows(spark, *values).select("i", text.tokens(F.col("value")).alias("t"))
    assert [list(r.t) for r in df.sort("i").collect()] == [java_split(v, " ") for v in values]


def test_tokens_take_any_separator(spark):
    for separator in ("\r\n", ",", "|", "."):
        values = ["", separator * 2, "a" + separator + "b" + separator, separator + "a", "plain"]
        df = rows(spark, *values).select("i", text.tokens(F.col("value"), separator).alias("t"))
        assert [list(r.t) for r in df.sort("i").collect()] == [java_split(v, separator) for v in values]


def test_lines_of_a_text(spark):
    values = ["", "a", "a\n", "a\n\nb", "a\r\nb\r\n", "\n", "a\rb\n"]
    df = rows(spark, *values).select("i", text.lines(F.col("value")).alias("t"))
    got = [list(r.t) for r in df.sort("i").collect()]
    assert got == [[], ["a"], ["a"], ["a", "", "b"], ["a", "b"], [""], ["a\rb"]]


def test_files_give_the_same_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one two\r\n\n  three  \nlast")
    assert on(lines.read_lines(spark, str(tmp_path)), "value") == [("",), ("  three  ",), ("last",), ("one two",)]
    stream = lines.stream_lines(spark, str(tmp_path))
    assert stream.isStreaming and stream.columns == ["value"]


def test_blank_lines_and_records(spark):
    df = rows(spark, "", "   ", "\t", "a", "b\r\nc\r\n")
    assert on(lines.without_blank(lines.split_records(df)), "value") == [("\t",), ("a",), ("b",), ("c",)]


def test_word_counts_keep_empty_words(spark):
    df = rows(spark, "a  b", "", "a ")
    assert on(words.word_counts(words.words(df)), "word", "n") == [("", 2), ("a", 2), ("b", 1)]
    assert on(words.word_counts(words.nonempty(words.words(df))), "word", "n") == [("a", 2), ("b", 1)]


def test_sorted_forms(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", 2)], "word string, n bigint")
    assert [r.word for r in words.sorted_totally(counts).collect()] == ["b", "c", "d", "a"]
    local = words.sorted_in_partitions(counts.repartition(2))
    parts = local.withColumn("p", F.spark_partition_id()).collect()
    for p in {r.p for r in parts}:
        n = [r.n for r in parts if r.p == p]
        assert n == sorted(n, reverse=True)


def test_routing_by_length(spark):
    df = words.words(rows(spark, "to be wonder", "questions be"))
    out = routing.split(df, counted=words.short(), rejected=~words.short())
    assert on(out["counted"], "word") == [("be",), ("be",), ("to",)]
    assert on(out["rejected"], "word") == [("questions",), ("wonder",)]
    shown = out["rejected"].select(text.prefixed(F.col("word"), "reject").alias("line"))
    assert on(shown, "line") == [("reject> questions",), ("reject> wonder",)]


def test_only_spaces_are_blank(spark):
    rows = spark.createDataFrame([(v,) for v in ("", "   ", " \r", "\u0085", "  \u2028", "\t", "a")], "value string")
    kept = [r.value for r in lines.without_blank(rows).collect()]
    assert kept == [" \r", "\u0085", "  \u2028", "\t", "a"]


def test_epoch_conversions(spark):
    df = spark.createDataFrame([(1511658000,), (1511690400,), (0,), (-1,)], "s bigint")
    ts = times.from_seconds(F.col("s"))
    out = df.select("s", times.to_seconds(ts).alias("back"), times.timestamp_text(ts).alias("text")).collect()
    assert [r.text for r in out] == [
        "2017-11-26 01:00:00.0", "2017-11-26 10:00:00.0", "1970-01-01 00:00:00.0", "1969-12-31 23:59:59.0",
    ]
    assert all(r.s == r.back for r in out)
    ms = spark.createDataFrame([(1511658000120,)], "ms bigint")
    assert ms.select(times.timestamp_text(times.from_millis(F.col("ms"))).alias("t")).first().t == "2017-11-26 01:00:00.12"


def test_readings(spark):
    df = spark.createDataFrame([("sensor_2", 1558430842000, 212.0)], "id string, ms bigint, t double")
    text_column = readings.reading_text(F.col("id"), times.from_millis(F.col("ms")), readings.celsius(F.col("t")))
    assert df.select(text_column.alias("r")).first().r == "SensorReading(sensor_2,1558430842000,100.0) 05-21_09:27:22"
