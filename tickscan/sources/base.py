"""One interface over tick sources: every source loads to the same tick columns, batch or stream.

``id, sec_type, last, trade_timestamp, wallclock_timestamp, delay, seq``
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ticks import delay_ms

TICK_COLUMNS = ["id", "sec_type", "last", "trade_timestamp", "wallclock_timestamp", "delay", "seq"]


class TickSource(Protocol):
    def load(self, spark: SparkSession) -> DataFrame: ...


@dataclass
class ParquetTicks:
    """Stored ticks (e.g. a region/symbol-partitioned table); filters on ``trade_timestamp`` and
    ``region`` reach the scan."""
    path: str
    stream: bool = False
    schema: str = ("id string, sec_type string, last string, trade_timestamp timestamp, "
                   "wallclock_timestamp timestamp, delay bigint, seq bigint")

    def load(self, spark: SparkSession) -> DataFrame:
        if self.stream:
            return spark.readStream.schema(self.schema).parquet(self.path)
        return spark.read.parquet(self.path)


@dataclass
class DayFileTicks:
    """Raw exchange day files or per-symbol files; as a stream (one folder) with the checkpoint of the
    query that reads it."""
    paths: list[str]
    per_symbol: bool = False
    checkpoint: str | None = None
    rejected: DataFrame | None = field(default=None, init=False)

    def load(self, spark: SparkSession) -> DataFrame:
        from .dayfile import DAY_FILE, SYMBOL_FILE, read_day_files, read_symbol_files
        if self.checkpoint:
            from .daystream import stream_day_files
            [path] = self.paths
            return stream_day_files(spark, path, self.checkpoint, layout=SYMBOL_FILE if self.per_symbol else DAY_FILE).drop("file")
        out = (read_symbol_files if self.per_symbol else read_day_files)(spark, self.paths)
        self.rejected = out.rejected
        return out.ticks.drop("file")


@dataclass
class TopicTicks:
    """Tick topics (stream), decoded with the message descriptor if there is one."""
    brokers: str
    topics: list[str]
    descriptor_file: str | None = None
    starting: str = "latest"
    extra: dict | None = None
    dead_letters: DataFrame | None = field(default=None, init=False)

    def load(self, spark: SparkSession) -> DataFrame:
        from .kafka import decode, kafka_reader, split_decoded, topic_ticks
        records = kafka_reader(spark, self.brokers, self.topics, self.starting, extra=self.extra)
        good, self.dead_letters = split_decoded(decode(records, self.descriptor_file))
        return topic_ticks(good)


def with_delay(ticks: DataFrame) -> DataFrame:
    """Fill ``delay`` from the two timestamps where it is missing."""
    return ticks.withColumn("delay", F.coalesce("delay", delay_ms("wallclock_timestamp", "trade_timestamp")))
