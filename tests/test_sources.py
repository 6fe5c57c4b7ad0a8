from datetime import datetime

import pytest
from conftest import on
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sinks import kafka as kafka_sink
from tidemark.sources import kafka, records


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], schemas.LINE)


def test_behaviors(spark):
    df = records.parse_behavior(lines(spark, "543462,1715,1464116,pv,1511658000,extra"))
    assert df.schema == schemas.USER_BEHAVIOR
    assert on(df, *df.columns) == [(543462, 1715, 1464116, "pv", datetime(2017, 11, 26, 1))]


@pytest.mark.parametrize("bad", ["1,2,3,pv", "x,2,3,pv,4", "1,2,99999999999,pv,4", "1,2,3,pv,9223372036854775807"])
def test_bad_behaviors(spark, bad):
    with pytest.raises((PySparkException, Py4JJavaError)):
        records.parse_behavior(lines(spark, bad)).collect()
    (row,) = records.parse_behavior(lines(spark, bad), strict=False).collect()
    assert None in tuple(row)


LOG = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET {url}"


def test_access_log(spark):
    df = records.parse_access_log(lines(spark, LOG.format(url="/a b"), LOG.format(url=" /moved")))
    assert df.schema.simpleString() == schemas.LOG_EVENT.simpleString()
    assert on(df, *df.columns) == [("83.149.9.216", datetime(2015, 5, 17, 10, 5, 3), "GET", "/a")]


@pytest.mark.parametrize("bad", ["short line", LOG.format(url="/a").replace("17/05", "32/13")])
def test_bad_access_log(spark, bad):
    with pytest.raises(PySparkException):
        records.parse_access_log(lines(spark, bad)).collect()
    (row,) = records.parse_access_log(lines(spark, bad), strict=False).collect()
    assert row.ts is None


def test_rows_in_memory(spark):
    df = records.from_rows(spark, [(1, "create", datetime(2019, 5, 21))], schemas.ORDER_EVENT)
    assert df.schema == schemas.ORDER_EVENT and df.count() == 1


def test_kafka_options():
    assert kafka.source_options("a:1,b:2", "lines", "readers", startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "lines",
        "kafka.group.id": "readers",
        "startingOffsets": "earliest",
    }
    assert kafka_sink.sink_options("a:1", "lines") == {"kafka.bootstrap.servers": "a:1", "topic": "lines"}


def test_kafka_payload(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, value string")
    assert kafka_sink.payload(df).columns == ["value"]
    keyed = kafka_sink.payload(df, key="id")
    assert keyed.schema.simpleString() == "struct<key:string,value:string>"
    assert on(keyed, F.col("key"), "value") == [("1", "a")]


def test_kafka_connector_is_asked_for(spark):
    """Without the connector on the classpath Spark says so; nothing is replaced silently."""
    for start in (kafka.stream_topic, kafka.read_topic):
        with pytest.raises(PySparkException, match="(?i)kafka"):
            start(spark, "localhost:1", "lines")


def test_strict_rows_are_checked_whole(spark):
    """A bad field fails the row although a filter and pruning leave it unused; padded numbers are bad."""
    for bad in ("x,7,notint,pv,1511658000", "1,2,3,buy,zzz", " 1,2,3,pv,1511658000", "1,2,3,pv"):
        frame = spark.createDataFrame([("1,2,3,pv,1511658000",), (bad,)], "value string")
        with pytest.raises(Exception, match="bad record"):
            records.parse_behavior(frame).where("behavior = 'pv'").select("item_id", "ts").collect()
        assert records.parse_behavior(frame, strict=False).count() == 2
    line = spark.createDataFrame([("83.1.1.1 - - 17/05/2015:10:05:03 +0000 GET ",)], "value string")
    with pytest.raises(Exception, match="bad record"):
        records.parse_access_log(line).select("url").collect()


def test_times_near_the_limit(spark):
    frame = spark.createDataFrame([("1,2,3,pv,9100000000000",), ("1,2,3,pv,9300000000000",)], "value string")
    got = [r.y for r in records.parse_behavior(frame, strict=False).selectExpr("year(ts) y").collect()]
    assert got == [290337, None]
