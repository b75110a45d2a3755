"""Registered streaming queries: the job replayed over the events feed, results read back.

Each query replays the whole ``events`` table as a tick feed in arrival micro-batches of 5 days
(wall-clock time plus the region's feed lag), through the real streaming job and its sinks, and
returns what the sinks hold. Replays are memoised per (tables, settings) within the process, so
the EMA and advisory queries share one run.

The oracle side is the batch semantics restricted to the windows the final watermark
(``max(trade time) - 10 s``) has closed: an unbounded stream never emits the still-open ones.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ticks import instant, region_of, wall_time
from ..operators.bars import duration_us
from ..plans import oracle as O
from ..session import folder_exists
from ..sources.tables import events_as_ticks
from .replay import Replay

ARRIVAL_PERIOD = "5 days"     # micro-batch length of the replayed feed
FEED_LAG = {"NL": "2 hours"}  # one region's feed reaches the engine late

_RUNS: dict[tuple, object] = {}


def arrival_batches(ticks: DataFrame, period: str = ARRIVAL_PERIOD, lags=None) -> DataFrame:
    """Arrival micro-batch of each tick: wall-clock time plus its region's feed lag, cut in periods."""
    lags = FEED_LAG if lags is None else lags
    lag_us = F.lit(0)
    for region, lag in lags.items():
        lag_us = F.when(region_of("id") == region, F.lit(duration_us(lag))).otherwise(lag_us)
    arrive = F.unix_micros(instant("wallclock_timestamp")) + lag_us
    return ticks.withColumn("batch", F.floor(arrive / F.lit(duration_us(period))).cast("long"))


def _memo(key, make):
    hit = _RUNS.get(key)
    if hit is not None and folder_exists(hit[0]):
        return hit[1]
    val = make()
    _RUNS[key] = val
    return val[1]


def _feed(spark: SparkSession, sf: str, lagged: bool) -> DataFrame:
    return arrival_batches(events_as_ticks(spark, sf), ARRIVAL_PERIOD, FEED_LAG if lagged else {})


def _trend_run(spark, sf, window="1 hour", stop_after=None) -> Replay:
    def make():
        r = Replay(spark, "trend-replay")
        r.run(_feed(spark, sf, False), window, stop_after=stop_after)
        return (r.root, r)
    return _memo(("trend", sf, window, stop_after), make)


def _bars_run(spark, sf, window, lagged) -> str:
    def make():
        r = Replay(spark, "bars-replay")
        r.run_bars(_feed(spark, sf, lagged), window)
        return (r.root, r.root + "/bars")
    return _memo(("bars", sf, window, lagged), make)


def _bars_out(df: DataFrame) -> DataFrame:
    return df.select("symbol", wall_time("window_start").alias("window_start"),
                     wall_time("window_end").alias("window_end"), "close",
                     wall_time("trade_timestamp").alias("trade_timestamp"), "ticks")


def q_stream_bars(spark, sf):
    return _bars_out(spark.read.parquet(_bars_run(spark, sf, "1 hour", False)))


def q_stream_late_drop(spark, sf):
    return _bars_out(spark.read.parquet(_bars_run(spark, sf, "1 minute", True)))


def _ema_out(t: DataFrame) -> DataFrame:
    return t.select("symbol", wall_time("trade_timestamp").alias("trade_timestamp"),
                    F.round("ema38", 6).alias("ema38"), F.round("ema100", 6).alias("ema100"))


def q_stream_ema(spark, sf):
    return _ema_out(_trend_run(spark, sf).ema_table())


def q_stream_crossovers(spark, sf):
    t = _trend_run(spark, sf).advisory_table()
    return t.select("symbol", wall_time("trade_timestamp").alias("trade_timestamp"),
                    F.col("advice").alias("message"))


def q_stream_restart(spark, sf):
    return _ema_out(_trend_run(spark, sf, stop_after=3).ema_table())


def q_stream_upsert_again(spark, sf):
    """The job run twice over the feed into the same tables, the second time without its checkpoint and
    with doubled prices: the first writer of each key stays."""
    def make():
        first = Replay(spark, "first-replay")
        first.run(_feed(spark, sf, False), "1 hour")
        again = Replay(spark, "second-replay", tables=first)
        again.run(_feed(spark, sf, False).withColumn("last", (F.col("last").cast("double") * 2).cast("string")), "1 hour")
        return (first.root, first)
    return _ema_out(_memo(("again", sf), make).ema_table())


def q_state_table(spark, sf):
    """The keyed state of the finished job as a table: each symbol's EMAs and number of bars."""
    from .inspect import ema_state
    s = ema_state(spark, _trend_run(spark, sf).checkpoint + "/trend")
    return s.select("symbol", F.round("ema38", 6).alias("ema38"), F.round("ema100", 6).alias("ema100"), "bars")


def q_stream_price_direction(spark, sf):
    """Direction of the last two ticks of each symbol from the live state, after a feed whose last batches
    bring late ticks."""
    from .job import read_tick_stream
    from .live import by_batch, price_direction_stream

    def make():
        r = Replay(spark, "direction-replay")
        out = r.root + "/directions"
        q = (price_direction_stream(read_tick_stream(spark, r.source)).writeStream.outputMode("update").foreachBatch(by_batch(out))
             .option("checkpointLocation", r.checkpoint).trigger(processingTime="200 milliseconds").start())
        # arrival in another order than trade time: later batches bring earlier ticks too
        feed = events_as_ticks(spark, sf)
        feed = feed.withColumn("batch", F.when(F.col("seq") % 7 == 0, F.lit(2)).when(F.col("seq") % 3 == 0, F.lit(0)).otherwise(F.lit(1)))
        try:
            for b in r.arrivals(feed):
                r.stage(b)
                q.processAllAvailable()
        finally:
            q.stop()
        return (r.root, out)
    t = spark.read.parquet(_memo(("direction", sf), make))
    last = t.groupBy("symbol").agg(F.max_by(F.struct("last_price", "previous_price", "direction"), "batch").alias("r"))
    return last.select("symbol", "r.*")


def q_stream_chart(spark, sf):
    """The charts of one share and of all: stored rows, then a live feed that repeats some of them with other
    values."""
    from ..plans.registry import OVERLAP_DAY, SHARE, SPLIT_DAY, _bumped, _ema_rows
    from ..session import scratch_path, write_and_read
    from .live import start_chart

    def make():
        root = scratch_path(spark, "chart")
        e = write_and_read(_ema_rows(spark, sf).withColumn("trade_timestamp", instant("trade_timestamp")), "ema-rows")
        old = write_and_read(e.where(F.col("trade_timestamp") < F.lit(SPLIT_DAY).cast("timestamp")), "chart-history")
        live = _bumped(e.where(F.col("trade_timestamp") >= F.lit(OVERLAP_DAY).cast("timestamp")))
        live = write_and_read(live.withColumn("batch", F.floor(F.unix_seconds("trade_timestamp") / (5 * 86400))), "chart-live")
        e.limit(0).write.parquet(f"{root}/in")
        feed = spark.readStream.schema(e.schema).parquet(f"{root}/in")
        charts = {name: start_chart(feed, old, f"{root}/{name}", f"{root}/check-{name}", name, processing_time="200 milliseconds")
                  for name in (SHARE, "ALL")}
        try:
            for b in sorted(r[0] for r in live.select("batch").distinct().collect()):
                part = live.where(F.col("batch") == b).drop("batch")
                part.unionByName(part.limit(50)).write.mode("append").parquet(f"{root}/in")  # some rows come twice
                for q in charts.values():
                    q.processAllAvailable()
        finally:
            for q in charts.values():
                q.stop()
        return (root, (root, list(charts)))
    root, names = _memo(("chart", sf), make)
    out = None
    for name in names:
        rows = spark.read.parquet(f"{root}/{name}").select(F.lit(name).alias("chart"), "symbol", "ema38", "ema100",
                                                           wall_time("trade_timestamp").alias("trade_timestamp"))
        out = rows if out is None else out.unionByName(rows)
    return out


HISTORY_SPLIT = "2024-01-15 00:00:00"  # the first run's feed ends here, inside the second one


def q_stream_bootstrap(spark, sf):
    """The job run over the first half of the feed; then, its checkpoint lost, a new one from the stored
    history over the whole feed: the rows of an uninterrupted run."""
    def make():
        feed = _feed(spark, sf, False)
        first = Replay(spark, "half-replay")
        first.run(feed.where(F.col("trade_timestamp") < F.lit(HISTORY_SPLIT).cast("timestamp_ntz")), "1 hour")
        again = Replay(spark, "bootstrap-replay", tables=first)
        again.run(feed, "1 hour", from_history=True)
        return (first.root, first)
    return _ema_out(_memo(("bootstrap", sf), make).ema_table())


DAY_FILE_BYTES = 4  # a trigger admits this part of all day files


def q_stream_day_files(spark, sf):
    """Raw day files of the feed read as a stream a quarter at a time, stopped inside a file and started
    again from its checkpoint; the valid ticks."""
    from ..operators.clean import valid_ticks
    from ..plans.registry import DAY_FILE_DESCRIPTION, DAY_FILE_PREAMBLE
    from ..session import scratch_path
    from ..sinks.files import to_raw_rows, write_day_files
    from ..sources.daystream import stream_day_files

    def make():
        root = scratch_path(spark, "day-stream")
        write_day_files(to_raw_rows(events_as_ticks(spark, sf)), f"{root}/in", DAY_FILE_PREAMBLE, DAY_FILE_DESCRIPTION)
        size = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/in").agg(F.sum("length")).first()[0]

        def start():
            ticks = stream_day_files(spark, f"{root}/in", f"{root}/check", "*.txt", max_bytes=size // DAY_FILE_BYTES, range_bytes=size // 32)
            return (ticks.writeStream.format("parquet").option("path", f"{root}/ticks").option("checkpointLocation", f"{root}/check")
                    .trigger(processingTime="100 milliseconds").start())

        q = start()
        try:
            while not q.lastProgress or q.lastProgress["numInputRows"] == 0:
                if q.exception():
                    raise q.exception()
                time.sleep(0.1)
            q.stop()
            q = start()
            q.processAllAvailable()
        finally:
            q.stop()
        return (root, f"{root}/ticks")
    out = valid_ticks(spark.read.parquet(_memo(("day-files", sf), make)))
    return out.select("id", "region", "last", "price", wall_time("trade_timestamp").alias("trade_timestamp"))


STREAM_QUERIES = {
    "stream_price_direction": q_stream_price_direction,
    "stream_chart": q_stream_chart,
    "stream_bootstrap": q_stream_bootstrap,
    "stream_state_table": q_state_table,
    "stream_day_files": q_stream_day_files,
    "stream_upsert_again": q_stream_upsert_again,
    "stream_bars": q_stream_bars,
    "stream_late_drop": q_stream_late_drop,
    "stream_ema": q_stream_ema,
    "stream_crossovers": q_stream_crossovers,
    "stream_restart": q_stream_restart,
}

_BOUND = duration_us("10 seconds")
_CLOSED = f"epoch_us(window_end) <= (SELECT max(epoch_us(trade_timestamp)) FROM vticks) - {_BOUND}"
_H1, _M1 = O.trend_with("1 hour"), O.trend_with("1 minute")
_EMA_CLOSED = _H1 + f"SELECT symbol, trade_timestamp, round(e38, 6) AS ema38, round(e100, 6) AS ema100 FROM emas WHERE {_CLOSED}"


def _late_bars_sql() -> str:
    """Bars of the ticks that a watermark of 10 s behind the maximum of earlier arrival batches lets in."""
    period, lag, size = duration_us(ARRIVAL_PERIOD), duration_us(FEED_LAG["NL"]), duration_us("1 minute")
    return O.with_base(f"""arr AS (
  SELECT *, (epoch_us(wallclock_timestamp) + CASE WHEN region = 'NL' THEN {lag} ELSE 0 END) // {period} AS batch
  FROM vticks)""", "bmax AS (SELECT batch, max(epoch_us(trade_timestamp)) AS m FROM arr GROUP BY batch)", f"""marks AS (
  SELECT batch, max(m) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {_BOUND} AS wm FROM bmax)""",
        f"""kept AS (
  SELECT a.* FROM arr a JOIN marks m USING (batch)
  WHERE NOT coalesce((epoch_us(a.trade_timestamp) // {size}) * {size} + {size} <= m.wm, false))""",
        O.bars_cte("1 minute", src="kept")) + f"SELECT symbol, window_start, window_end, close, trade_timestamp, ticks FROM bars WHERE {_CLOSED}"


def stream_oracle(direction_sql: str, kept_ema: str, ema_table: str, share: str) -> dict[str, str]:
    """SQL of the stream queries that state what a batch query states."""
    return {
        "stream_price_direction": direction_sql,
        "stream_chart": _M1 + f"""SELECT chart, symbol, ema38, ema100, trade_timestamp FROM (SELECT {kept_ema} FROM ({ema_table})) t,
  (VALUES ('{share}'), ('ALL')) c(chart) WHERE chart = 'ALL' OR symbol = chart""",
    }


STREAM_ORACLE = {
    "stream_bootstrap": _EMA_CLOSED,
    "stream_state_table": _H1 + f"""SELECT symbol, round(arg_max(e38, window_start), 6) AS ema38, round(arg_max(e100, window_start), 6) AS ema100,
       count(*) AS bars FROM emas WHERE {_CLOSED} GROUP BY symbol""",
    "stream_day_files": O.with_base() + "SELECT id, region, last, price, trade_timestamp FROM vticks",
    "stream_upsert_again": _EMA_CLOSED,
    "stream_bars": O.with_base(O.bars_cte("1 hour")) + f"SELECT * EXCLUDE (ticks), ticks FROM bars WHERE {_CLOSED}",
    "stream_late_drop": _late_bars_sql(),
    "stream_ema": _EMA_CLOSED,
    "stream_crossovers": _H1 + f"SELECT symbol, trade_timestamp, message FROM advs WHERE {_CLOSED}",
    "stream_restart": _EMA_CLOSED,
}
