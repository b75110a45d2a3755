"""Layer 4: stream faults - late rows dropped, replayed batches change nothing, restart equals a
straight run."""
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickscan.streaming.registry import arrival_batches
from tickscan.sources.tables import events_as_ticks
from tickscan.streaming.job import write_batch
from tickscan.streaming.replay import Replay


def test_late_row_dropped(spark):
    ticks = arrival_batches(events_as_ticks(spark, SF_SMALL), "5 days", {})
    last = ticks.agg(F.max("trade_timestamp")).first()[0]
    # one tick of the first day, sent again in a final batch of its own, long after its window closed
    late = (ticks.orderBy("seq").limit(1)
                 .withColumn("batch", F.lit(10_000).cast("long")).withColumn("seq", F.lit(-1).cast("long"))
                 .withColumn("last", F.lit("99999.0")))
    r = Replay(spark, "late-test")
    bars = r.run_bars(ticks.unionByName(late), "1 hour")
    assert bars.where(F.col("close") == 99999.0).count() == 0
    assert bars.agg(F.max("trade_timestamp")).first()[0] <= last


def test_replayed_batch_changes_nothing(spark):
    r = Replay(spark, "replay-test")
    r.run(arrival_batches(events_as_ticks(spark, SF_SMALL), "5 days", {}), "1 hour")
    before = r.ema_table().count(), r.advisory_table().count()
    # the job's output re-delivered after a failure: the same rows (EMAs + messages) through the sink again
    adv = r.advisory_table().select("symbol", "trade_timestamp", F.col("advice").alias("message"))
    rows = (r.ema_table().join(adv, ["symbol", "trade_timestamp"], "left")
             .withColumn("window_start", F.col("trade_timestamp")).withColumn("window_end", F.col("trade_timestamp"))
             .withColumn("close", F.lit(0.0)))
    write_batch(rows, r.ema_path, r.advisory_path)
    assert (r.ema_table().count(), r.advisory_table().count()) == before
    assert os.path.isdir(r.checkpoint.replace("file:", ""))
