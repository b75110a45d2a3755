"""Replay of a stored tick table through the streaming job, for the registered stream queries and tests.

``Replay`` writes the table once, partitioned by arrival batch, and hands the batches to the job's
source folder one after the other (one append per batch, then ``processAllAvailable``), so that late
data, restarts and replays can be exercised deterministically on real tables.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.ticks import instant
from ..schemas import DEFAULT_SPANS, LATENESS_BOUND
from ..session import scratch_path
from .job import STREAM_TICK_SCHEMA, read_tick_stream, start_job, stream_bars


def drain(q: StreamingQuery, timeout_s: float = 120.0) -> None:
    """Wait until the query has processed all input and run the follow-up batch that emits the
    windows its last watermark closed."""
    q.processAllAvailable()
    last = q.lastProgress
    target = (last["batchId"] + 1) if last else 0
    t0 = time.time()
    while time.time() - t0 < timeout_s:
        p = q.lastProgress
        if p and p["batchId"] >= target and p["numInputRows"] == 0:
            return
        time.sleep(0.2)
        if q.exception():
            raise q.exception()


class _partitions:
    """Run a stream with a given shuffle partition count (the state store keeps it per checkpoint)."""

    def __init__(self, spark: SparkSession, n: int):
        self.spark, self.n = spark, str(n)

    def __enter__(self):
        self.old = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", self.n)

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.old)


class Replay:
    """Feed a tick DataFrame with a ``batch`` column to a streaming job, one arrival batch at a time.

    State partitions = the cluster's default parallelism (``state_partitions`` to override). With
    ``tables``, the rows go to the tables of that other replay, whose checkpoint is not used."""

    def __init__(self, spark: SparkSession, name: str = "replay", state_partitions: int | None = None,
                 tables: Replay | None = None):
        self.spark = spark
        self.state_partitions = state_partitions or spark.sparkContext.defaultParallelism
        self.root = scratch_path(spark, name)
        self.source = self.root + "/source"
        self.ema_path = tables.ema_path if tables else self.root + "/ema_results"
        self.advisory_path = tables.advisory_path if tables else self.root + "/buy_advisories"
        self.checkpoint = self.root + "/checkpoint"
        # the source folder must exist before the stream starts
        spark.createDataFrame([], STREAM_TICK_SCHEMA).write.mode("append").parquet(self.source)

    def arrivals(self, ticks: DataFrame) -> list:
        """Write the ticks partitioned by batch; returns the batches in order (a replay has few)."""
        (ticks.select("id", "sec_type", "last", instant("trade_timestamp").alias("trade_timestamp"),
                      instant("wallclock_timestamp").alias("wallclock_timestamp"), "delay", "seq", "batch")
              .write.mode("append").partitionBy("batch").parquet(self.root + "/arrivals"))
        self.feed = self.spark.read.parquet(self.root + "/arrivals")
        return sorted(r[0] for r in self.feed.select("batch").distinct().collect())

    def stage(self, b) -> None:
        self.feed.where(F.col("batch") == F.lit(b)).drop("batch").write.mode("append").parquet(self.source)

    def run(self, ticks: DataFrame, window: str, spans=DEFAULT_SPANS, bound: str = LATENESS_BOUND,
            stop_after: int | None = None, from_history: bool = False) -> None:
        """Replay all batches; with ``stop_after``, stop the query after that many batches and restart it
        from its checkpoint for the rest."""
        batches = self.arrivals(ticks)

        def start():
            return start_job(read_tick_stream(self.spark, self.source), self.ema_path, self.advisory_path,
                             self.checkpoint, window, spans, bound, processing_time="200 milliseconds",
                             from_history=from_history)[0]

        with _partitions(self.spark, self.state_partitions):
            self._run(batches, start, stop_after)

    def _run(self, batches, start, stop_after):
        q = start()
        try:
            for i, b in enumerate(batches):
                self.stage(b)
                q.processAllAvailable()
                if stop_after is not None and i + 1 == stop_after:
                    q.stop()
                    q = start()
            drain(q)
        finally:
            q.stop()

    def run_bars(self, ticks: DataFrame, window: str, bound: str = LATENESS_BOUND) -> DataFrame:
        """Replay all batches through the bar stage alone (append mode, Parquet sink); returns the bars."""
        out = self.root + "/bars"
        with _partitions(self.spark, self.state_partitions):
            self._run_bars(ticks, window, bound, out)
        return self.spark.read.parquet(out)

    def _run_bars(self, ticks, window, bound, out):
        q = (stream_bars(read_tick_stream(self.spark, self.source), window, bound)
             .writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", self.checkpoint + "/bars").option("path", out)
             .trigger(processingTime="200 milliseconds").start())
        try:
            for b in self.arrivals(ticks):
                self.stage(b)
                q.processAllAvailable()
            drain(q)
        finally:
            q.stop()

    def ema_table(self) -> DataFrame:
        return self.spark.read.parquet(self.ema_path)

    def advisory_table(self) -> DataFrame:
        return self.spark.read.parquet(self.advisory_path)
