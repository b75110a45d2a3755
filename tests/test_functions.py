"""Scalar functions: parsing, id tokens, delay, proto timestamps, routing."""
from datetime import datetime

from pyspark.sql import functions as F

from tickscan.functions import ticks as T


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_parse_trade_ts(spark):
    vals = one(spark, T.parse_trade_ts("d", "t"),
               [("08-11-2021", "10:00:00.100"), ("08-11-2021", "10:00:00"), ("", "10:00:00"),
                ("8-11-2021", "10:00:00"), ("08-11-2021", "10:00:00.123456789")], "d string, t string")
    assert vals[0] == datetime(2021, 11, 8, 10, 0, 0, 100000)
    assert vals[1] == datetime(2021, 11, 8, 10, 0, 0)
    assert vals[2] is None
    assert vals[4] == datetime(2021, 11, 8, 10, 0, 0, 123456)


def test_region_and_share(spark):
    data = [("AAA.FR",), ("AAA",), ("A.B.C",), ("",), ("AAA.",), (".FR",)]
    assert one(spark, T.region_of("id"), data, "id string") == ["FR", None, "B", None, None, "FR"]
    assert one(spark, T.share_of("id"), data, "id string") == ["AAA", "AAA", "A", None, "AAA", None]


def test_price(spark):
    vals = one(spark, T.price_of("last"), [("",), ("abc",), ("1e3",), ("-5",), ("10.5",)], "last string")
    assert vals == [None, None, 1000.0, -5.0, 10.5]


def test_delay_and_proto(spark):
    df = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59, 500000), datetime(1970, 1, 1, 0, 0, 0, 250000))],
                               "t timestamp, w timestamp")
    r = df.select(T.delay_ms("w", "t").alias("d"), T.to_proto_ts("t").alias("p")).first()
    assert r["d"] == 750
    assert (r["p"]["seconds"], r["p"]["nanos"]) == (-1, 500000000)
    back = df.select(T.from_proto_ts(T.to_proto_ts("t")).alias("b")).first()["b"]
    assert back == datetime(1969, 12, 31, 23, 59, 59, 500000)


def test_topic_kind(spark):
    vals = one(spark, T.topic_kind("t"), [("FR-ticks",), ("FR-ema",), ("NL-advisories",), ("other",)], "t string")
    assert vals == ["ticks", "ema", "advisories", "unknown"]
