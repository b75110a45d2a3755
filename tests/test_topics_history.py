"""Topic option builders, topic frames, and the history dispatch (no broker needed)."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickscan.operators import history as H
from tickscan.sources.kafka import kafka_options, kafka_sink_options, to_topic_frame
from tickscan.streaming.job import topic_frames


def test_kafka_options():
    o = kafka_options("b:9092", ["FR-ticks", "NL-ticks"], "earliest", group="g")
    assert o["subscribe"] == "FR-ticks,NL-ticks" and o["startingOffsets"] == "earliest" and o["kafka.group.id"] == "g"
    assert kafka_sink_options("b:9092", "FR-ema", "/ck")["kafka.compression.type"] == "snappy"


def test_topic_frames(spark):
    batch = spark.createDataFrame(
        [("A.FR", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 0, 0, 30), 1.0, 0.1, 0.05, "Buy!"),
         ("B.NL", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 0, 0, 40), 2.0, 0.2, 0.1, None)],
        "symbol string, window_start timestamp, window_end timestamp, trade_timestamp timestamp, close double, "
        "ema38 double, ema100 double, message string")
    got = sorted((r["topic"], r["key"].decode()) for r in topic_frames(batch).collect())
    assert got == [("FR-advisories", "A.FR"), ("FR-ema", "A.FR"), ("NL-ema", "B.NL")]
    f = to_topic_frame(batch.select("symbol", "ema38"))
    assert f.columns == ["key", "value"] and b'"ema38":0.1' in f.first()["value"]


def test_history_dispatch(spark):
    ema = spark.createDataFrame(
        [("A.FR", 1.0, 2.0, datetime(2024, 1, 1, 10, 0)), ("A.FR", 1.1, 2.1, datetime(2024, 1, 1, 11, 0)),
         ("A.FR", 1.2, 2.2, datetime(2024, 1, 1, 11, 40)), ("B.NL", 3.0, 4.0, datetime(2024, 1, 1, 9, 0))],
        "symbol string, ema38 double, ema100 double, trade_timestamp timestamp")
    adv = spark.createDataFrame([("A.FR", "Sell!", datetime(2024, 1, 1, 11, 0))],
                                "symbol string, advice string, trade_timestamp timestamp")
    rows = H.history("FR-ema", "A.FR", ema, adv).collect()
    assert [r["trade_timestamp"].hour for r in rows] == [10, 11, 11]      # 100 minutes back, inclusive
    a = H.history("FR-advisories", "A.FR", ema, adv).collect()
    assert [(r["message"], r["flag"], r["clock"]) for r in a] == [("Sell!", -1, "11:00:00")]
    assert H.history("FR-ticks", "A.FR", ema, adv).count() == 0
    with pytest.raises(ValueError):
        H.history("FR-ema", None, ema, adv)


def test_messages_and_routing(spark):
    from tickscan.operators.latency import split_by_kind
    ema = spark.createDataFrame([("A.FR", 1.0, 2.0, datetime(1969, 12, 31, 23, 59, 59, 250000))],
                                "symbol string, ema38 double, ema100 double, trade_timestamp timestamp")
    m = H.as_messages(ema).first()
    assert (m["trade_ts"]["seconds"], m["trade_ts"]["nanos"]) == (-1, 250000000)
    recs = spark.createDataFrame([("FR-ticks",), ("FR-ema",), ("NL-advisories",), ("x",)], "topic string")
    parts = split_by_kind(recs)
    assert {k: v.count() for k, v in parts.items()} == {"ticks": 1, "ema": 1, "advisories": 1, "unknown": 1}


def test_dead_letters_and_state_ttl(spark):
    from tickscan.sources.kafka import split_decoded
    from tickscan.streaming.state import EmaCrossoverProcessor
    recs = spark.createDataFrame([("FR-ticks", bytearray(b"x"), ("A.FR",)), ("FR-ticks", bytearray(b"y"), None)],
                                 "topic string, value binary, msg struct<id:string>")
    good, dead = split_decoded(recs)
    assert good.count() == 1 and dead.columns == ["topic", "value"] and dead.count() == 1

    seen = {}

    class Handle:
        def getValueState(self, name, schema, ttl=None):
            seen["ttl"] = ttl
            return None

    EmaCrossoverProcessor(ttl_ms=3_600_000).init(Handle())
    assert seen["ttl"] == 3_600_000
