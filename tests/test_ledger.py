"""The ledger of a history table: one row per key whatever wrote before, few files opened."""
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tickscan.sinks import ledger
from tickscan.sinks.tables import insert_if_absent, latest_times, read_table, write_advisories, write_ema_rows
from tickscan.streaming.job import batch_writer

EMA = "symbol string, ema38 double, ema100 double, trade_timestamp timestamp"
T0 = datetime(2024, 1, 1)


def ema(spark, rows):
    return spark.createDataFrame([(s, v, v, T0 + timedelta(minutes=m)) for s, m, v in rows], EMA)


def stored(spark, path):
    return {(r["symbol"], int((r["trade_timestamp"] - T0).total_seconds() // 60)): r["ema38"] for r in read_table(spark, path).collect()}


def count_is(spark, path, n):
    assert read_table(spark, path).count() == n == read_table(spark, path).select("symbol", "trade_timestamp").distinct().count()


def test_second_stream_over_a_filled_table(spark, tmpdir_path):
    e, a = os.path.join(tmpdir_path, "e"), os.path.join(tmpdir_path, "a")
    rows = lambda k, v: ema(spark, [(f"{k}.FR", 10 * k, v)]).withColumn("message", F.lit("Buy!"))
    first = batch_writer(e, a)
    for k in range(3):
        first(rows(k, 1.0), k)
    again = batch_writer(e, a)          # lost checkpoint: batch numbers start anew, values differ
    for k in range(3):
        again(rows(k, 2.0), k)
    assert stored(spark, e) == {(f"{k}.FR", 10 * k): 1.0 for k in range(3)}
    count_is(spark, e, 3)
    count_is(spark, a, 3)


def test_tokens(spark, tmpdir_path):
    e, a = os.path.join(tmpdir_path, "e"), os.path.join(tmpdir_path, "a")
    rows = ema(spark, [("A.FR", 1, 1.0), ("B.FR", 2, 1.0)])
    assert not write_ema_rows(rows, e, token="q-0").known
    # the run died here: the advisories of batch 0 are missing; its replay skips the first table only
    assert write_ema_rows(rows, e, token="q-0").known
    assert not write_advisories(rows.select("symbol", "trade_timestamp", F.lit("Buy!").alias("message")), a, token="q-0").known
    count_is(spark, e, 2)
    count_is(spark, a, 2)
    # another stream's batch 0 is another batch
    done = write_ema_rows(ema(spark, [("A.FR", 1, 5.0), ("C.FR", 3, 5.0)]), e, token="other-0")
    assert not done.known and stored(spark, e) == {("A.FR", 1): 1.0, ("B.FR", 2): 1.0, ("C.FR", 3): 5.0}


def test_files_opened(spark, tmpdir_path):
    e = os.path.join(tmpdir_path, "e")
    for k in range(12):  # a live stream: each batch is later than all before
        done = write_ema_rows(ema(spark, [(f"S{j}.FR", 90 * k + j, 1.0) for j in range(20)]), e, files_per_day=1)
        assert (done.stored, done.opened) == (k, 0)
    done = write_ema_rows(ema(spark, [(f"S{j}.FR", 90 * 5 + j, 2.0) for j in range(20)]), e, files_per_day=1)
    assert (done.stored, done.opened) == (12, 1)           # a batch replayed without token
    day = [(f"S{j}.FR", m, 3.0) for j in range(20) for m in range(0, 1080, 7)]
    done = write_ema_rows(ema(spark, day), e, files_per_day=1)   # a backfill over the whole day
    have = {(f"S{j}.FR", 90 * k + j) for k in range(12) for j in range(20)}
    got = stored(spark, e)
    assert set(got) == have | {(s, m) for s, m, _ in day} and all(got[k] == 1.0 for k in have)
    count_is(spark, e, len(got))
    # keys inside a file's ranges that it doesn't hold: the filter keeps almost all files closed
    done = write_ema_rows(ema(spark, [(f"S{j}.FR", 90 * 5 + (j + 1) % 20, 4.0) for j in range(20) if (90 * 5 + (j + 1) % 20) % 7]), e)
    assert done.stored >= 13 and done.opened <= 1


def test_files_of_others_and_crashes(spark, tmpdir_path):
    e = os.path.join(tmpdir_path, "e")
    write_ema_rows(ema(spark, [("A.FR", 1, 1.0)]), e)
    # written, but neither indexed nor marked: a batch that died, or another program
    (ema(spark, [("B.FR", 2, 1.0)]).withColumn("trade_date", F.to_date("trade_timestamp"))
        .write.mode("append").partitionBy("trade_date").parquet(e))
    done = write_ema_rows(ema(spark, [("A.FR", 1, 2.0), ("B.FR", 2, 2.0), ("C.FR", 3, 2.0)]), e)
    assert done.opened == 2
    assert stored(spark, e) == {("A.FR", 1): 1.0, ("B.FR", 2): 1.0, ("C.FR", 3): 2.0}
    assert write_ema_rows(ema(spark, [("Z.FR", 900, 1.0)]), e).opened == 0   # indexed by now
    assert sorted(tuple(r) for r in latest_times(spark, e).collect()) == [
        (s, T0 + timedelta(minutes=m)) for s, m in (("A.FR", 1), ("B.FR", 2), ("C.FR", 3), ("Z.FR", 900))]


def test_many_keys_and_pages(spark, tmpdir_path):
    e = os.path.join(tmpdir_path, "e")
    n = 3 * ledger.KEYS_PER_PAGE
    rows = spark.range(n).select(F.concat(F.lit("S"), F.col("id") % 50, F.lit(".FR")).alias("symbol"), F.lit(1.0).alias("ema38"),
                                 F.lit(1.0).alias("ema100"), F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("id") / 50)).alias("trade_timestamp"))
    insert_if_absent(rows, e, files_per_day=1)
    index = ledger.read_index(spark, e, ["2024-01-01"]).first()
    assert index["n"] == n and index["pages"] == 3 and len(index["filter"]) == 3
    assert insert_if_absent(rows.withColumn("ema38", F.lit(2.0)), e).opened == 1
    assert read_table(spark, e).where("ema38 = 2").count() == 0
    half = rows.withColumn("trade_timestamp", F.col("trade_timestamp") + F.expr("INTERVAL 500 MILLISECONDS"))
    asked = half.withColumn("trade_date", F.to_date("trade_timestamp"))
    assert ledger.candidates(asked, e, ledger.day_spans(asked, "trade_timestamp"), ["symbol", "trade_timestamp"], "trade_timestamp").files
    insert_if_absent(half, e)
    count_is(spark, e, 2 * n)
    assert insert_if_absent(rows.limit(0), e).days == 0


def test_few_rows_few_files(spark, tmpdir_path):
    """A batch adds files to a day by its rows there, not by the most there may be."""
    e = os.path.join(tmpdir_path, "e")
    write_ema_rows(ema(spark, [(f"S{j}.FR", j, 1.0) for j in range(200)]), e)
    assert len(ledger.day_files(spark, e, ledger.days_of(spark, e))) == 1
    count_is(spark, e, 200)
