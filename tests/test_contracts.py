"""Contracts of the job: flat prices, null arrival numbers, sinks after faults, topics, raw files, TTL."""
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickscan.operators.bars import bars, window_index
from tickscan.operators.ema import crossovers, ema
from tickscan.sinks.files import capture
from tickscan.sinks.tables import first_of_key, write_advisories, write_ema_rows
from tickscan.sources.base import TopicTicks
from tickscan.sources.dayfile import read_day_files
from tickscan.sources.kafka import flat_message, kafka_options, kafka_reader, split_decoded, topic_ticks
from tickscan.streaming.job import batch_writer, read_tick_stream, trend_stream
from test_dayfile import DESC, HEAD, PRE, write


def sequential(closes, spans=(38, 100)):
    cur, out = [0.0] * len(spans), []
    for n, p in enumerate(closes):
        prev, cur = cur, [p * (2 / (s + 1)) + e * (1 - 2 / (s + 1)) for s, e in zip(spans, cur)]
        if cur[0] > cur[1] and prev[0] <= prev[1]:
            out.append((n, "Buy!"))
        elif cur[0] < cur[1] and prev[0] >= prev[1]:
            out.append((n, "Sell!"))
    return out


def test_flat_and_step_prices_give_the_sequential_advisories(spark):
    paths = {"F100": [100.0] * 5000, "F1037": [10.37] * 5000, "F173": [17.3] * 5000,
             "S": [100.0 + 5 * (n // 700 % 3) for n in range(5000)], "P": [10.0 + 0.01 * (n // 900 % 2) for n in range(5000)]}
    b = spark.createDataFrame([(s, n, p) for s, x in paths.items() for n, p in enumerate(x)], "symbol string, w long, close double")
    got = crossovers(ema(b, with_previous=True)).select("symbol", "w", "message").collect()
    for s, x in paths.items():
        assert sorted((r["w"], r["message"]) for r in got if r["symbol"] == s) == sequential(x)


def test_null_seq_orders_first(spark):
    t = datetime(2024, 1, 1)
    rows = [("A.FR", t, None, 1.0), ("A.FR", t, 5, 2.0), ("A.FR", t, None, 3.0), ("B.FR", t, None, 4.0)]
    ticks = spark.createDataFrame(rows, "id string, trade_timestamp timestamp, seq long, price double")
    assert {r["symbol"]: r["close"] for r in bars(ticks, "1 minute").collect()} == {"A.FR": 2.0, "B.FR": 4.0}


def test_window_index_is_exact_far_away(spark):
    for t in (datetime(9999, 12, 31, 23, 59, 59, 999999), datetime(1, 1, 1, 0, 0, 0, 1), datetime(1969, 12, 31, 23, 59, 59, 999999)):
        df = spark.createDataFrame([(t,)], "t timestamp_ntz").select(window_index("t", "1 minute").alias("w"))
        assert df.first()["w"] == (t - datetime(1970, 1, 1)) // timedelta(minutes=1)


EMA = "symbol string, ema38 double, ema100 double, trade_timestamp timestamp"


def test_insert_without_success_marker(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "ema")
    rows = spark.createDataFrame([("A.FR", 1.0, 2.0, datetime(2024, 1, 1, 10)), ("B.FR", 1.0, 2.0, datetime(2024, 1, 1, 10))], EMA)
    write_ema_rows(rows, p)
    for name in ("_SUCCESS", "._SUCCESS.crc"):
        if os.path.exists(f"{p}/{name}"):
            os.remove(f"{p}/{name}")
    write_ema_rows(rows, p)
    assert spark.read.parquet(p).count() == 2


def test_first_of_key_is_the_same_always(spark):
    rows = spark.createDataFrame([("A", 3.0, 1.0, datetime(2024, 1, 1)), ("A", 2.0, 9.0, datetime(2024, 1, 1))], EMA)
    assert [r["ema38"] for r in first_of_key(rows.repartition(2), ["symbol", "trade_timestamp"]).collect()] == [2.0]
    assert [r["ema38"] for r in first_of_key(rows, ["symbol", "trade_timestamp"], ["ema100"]).collect()] == [3.0]


def test_crash_between_the_tables_and_replayed_id(spark, tmpdir_path):
    e, a = (os.path.join(tmpdir_path, n) for n in ("ema", "adv"))
    out = "symbol string, ema38 double, ema100 double, trade_timestamp timestamp, message string"
    one = spark.createDataFrame([("A.FR", 1.0, 2.0, datetime(2024, 1, 1, 10), "Buy!")], out)
    two = spark.createDataFrame([("A.FR", 2.0, 2.0, datetime(2024, 1, 1, 11), None)], out)
    write_ema_rows(one.drop("message"), e)                 # the run died before the advisories
    again = batch_writer(e, a)
    again(one, 7)                                          # the engine gives batch 7 again
    again(two, 8)
    restarted = batch_writer(e, a)
    restarted(two, 8)
    assert spark.read.parquet(e).count() == 2
    assert [r["advice"] for r in spark.read.parquet(a).collect()] == ["Buy!"]


def decoded(spark, nested: bool):
    t = datetime(2024, 1, 1, 10, 0, 0, 250000)
    stamp = {"seconds": 1704103200, "nanos": 250000000} if nested else t
    kind = "struct<seconds:bigint,nanos:int>" if nested else "timestamp"
    msg = f"struct<id:string,sec_type:string,last:string,trade_timestamp:{kind},wallclock_timestamp:{kind},delay:bigint>"
    rows = [("FR-ticks", 5, ("A.FR", "E", "1.5", stamp, stamp, 0)), ("FR-ticks", 6, None)]
    return spark.createDataFrame(rows, f"topic string, offset long, msg {msg}"), t


@pytest.mark.parametrize("nested", [False, True])
def test_topic_ticks_and_capture(spark, tmpdir_path, nested):
    frame, t = decoded(spark, nested)
    good, bad = split_decoded(frame)
    assert bad.count() == 1
    r = topic_ticks(good).first()
    assert (r["id"], r["last"], r["trade_timestamp"], r["seq"]) == ("A.FR", "1.5", t, 5)
    out = os.path.join(tmpdir_path, f"capture{nested}")
    capture(flat_message(good, "topic"), out)
    back = spark.read.option("header", "true").csv(out).first()
    assert back["id"] == "A.FR" and back["topic"] == "FR-ticks" and int(back["benchmark_timestamp"]) > 1_600_000_000_000


def test_topic_options(spark):
    assert "failOnDataLoss" not in kafka_options("b:1", ["x", "y"])
    assert kafka_options("b:1", "x", extra={"failOnDataLoss": "false", "maxOffsetsPerTrigger": "9"})["maxOffsetsPerTrigger"] == "9"
    with pytest.raises(ValueError):
        kafka_reader(spark, "b:1", "x", "latest", stream=False)
    assert TopicTicks("b:1", ["x"], "d.desc").dead_letters is None


def test_files_without_a_header_are_listed(spark, tmpdir_path):
    write(tmpdir_path, "good.csv", PRE + HEAD + DESC + "A.FR,E,1,08-11-2021,10:00:00,x\n")
    write(tmpdir_path, "short.csv", "one\ntwo\n")
    write(tmpdir_path, "empty.csv", "")
    out = read_day_files(spark, tmpdir_path)
    assert sorted(os.path.basename(r["file"]) for r in out.rejected.collect()) == ["empty.csv", "short.csv"]
    assert [r["id"] for r in out.ticks.collect()] == ["A.FR"]


def test_seq_follows_the_file_over_splits(spark, tmpdir_path):
    write(tmpdir_path, "long.csv", PRE + HEAD + DESC + "".join(f"A.FR,E,{n},08-11-2021,10:00:00,x\n" for n in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        t = read_day_files(spark, tmpdir_path).ticks
        rows = sorted((r["seq"], int(r["last"])) for r in t.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [n for _, n in rows] == list(range(3000)) and len({s for s, _ in rows}) == 3000


def test_state_with_ttl_runs(spark, tmpdir_path):
    src, out = (os.path.join(tmpdir_path, n) for n in ("src", "out"))
    rows = [("A.FR", "E", "1.0", datetime(2024, 1, 1, 10, m), None, None, m) for m in range(30)]
    schema = "id string, sec_type string, last string, trade_timestamp timestamp, wallclock_timestamp timestamp, delay bigint, seq bigint"
    spark.createDataFrame(rows, schema).write.parquet(src)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        q = (trend_stream(read_tick_stream(spark, src), ttl_ms=3_600_000, min_bars=2).writeStream.format("parquet")
             .option("checkpointLocation", out + "-ckpt").option("path", out).trigger(availableNow=True).start())
        q.awaitTermination(120)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    t = spark.read.parquet(out)
    assert t.count() >= 20 and t.where(F.col("message").isNotNull()).count() == 0
