"""History tables: day-partitioned Parquet with insert-if-absent on ``(symbol, trade_timestamp)``.

The reference stores EMA rows and advisories with ``ON CONFLICT DO NOTHING``, i.e. the first
writer of a key wins, whatever the batch and whoever wrote before. Here every insert is checked:
a batch is reduced to one row of each key, the table's ledger (``sinks/ledger.py``) names the few files
of the days it touches that may hold one of its keys, and only those are opened and anti-joined. What
is left is appended and indexed. A batch with a token (the stream's id and batch number) that the
ledger has is skipped whole. One writer per table; a stream's ``foreachBatch`` is that writer.

A crash at any point leaves rows that the next insert finds: files without an index row are opened,
and the token is written last.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ADVISORY_TABLE_KEY, EMA_TABLE_KEY, PARTITION_COLUMN
from . import ledger

#: Files that one batch adds to a day at most; a day's rows are hashed by key over them.
FILES_PER_DAY = 8
#: Rows of a day that a batch writes to one file before it takes another: a small batch adds one file a day.
ROWS_PER_FILE = 50_000


class Inserted(NamedTuple):
    """What an insert did: days touched, files stored in them before, files it opened, whether the
    batch was known."""

    days: int
    stored: int
    opened: int
    known: bool


def with_partition(rows: DataFrame, ts_col: str = "trade_timestamp") -> DataFrame:
    """Add the day partition column ``trade_date``."""
    return rows.withColumn(PARTITION_COLUMN, F.to_date(ts_col))


def first_of_key(rows: DataFrame, key, order: list[str] | None = None) -> DataFrame:
    """One row of each key: the smallest by ``order``, then by the other columns (so always the same)."""
    key, order = list(key), list(order or [])
    rest = order + [c for c in rows.columns if c not in key and c not in order]
    picked = rows.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_first"))
    return picked.select(*[c if c in key else F.col(f"_first.{c}").alias(c) for c in rows.columns])


def insert_if_absent(rows: DataFrame, path: str, key=EMA_TABLE_KEY, ts_col: str = "trade_timestamp",
                     order: list[str] | None = None, token: str | None = None,
                     files_per_day: int = FILES_PER_DAY) -> Inserted:
    """Append the rows of ``rows`` whose key is not stored yet. ``token`` names the batch for good."""
    spark = rows.sparkSession
    key = list(key)
    if token and ledger.has_batch(spark, path, token):
        return Inserted(0, 0, 0, True)
    batch = with_partition(first_of_key(rows, key, order), ts_col).persist()
    try:
        spans = ledger.day_spans(batch, ts_col)
        days = [r[PARTITION_COLUMN] for r in spans]
        keys = T.StructType([batch.schema[c] for c in [*key, PARTITION_COLUMN]])
        before = ledger.candidates(batch, path, spans, key, ts_col)
        new, ask = batch, before.to_open()
        if ask:
            stored = ledger.read_files(spark, path, ask, keys)
            new = batch.join(stored, [*key, PARTITION_COLUMN], "left_anti")
        if days:
            # a day's rows go to a few tasks by key: neither one task for a hot day nor a file per task and day
            files = min(files_per_day, max(1, -(-max(r["n"] for r in spans) // ROWS_PER_FILE)))
            bucket = F.pmod(F.xxhash64(*key), F.lit(files))
            (new.repartition(PARTITION_COLUMN, bucket).sortWithinPartitions(PARTITION_COLUMN, *key)
                .write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path))
            after = ledger.day_files(spark, path, days)
            ledger.write_index(spark, path, {f: p for f, p in after.items() if f in before.unlisted or f not in before.files},
                               key, ts_col, batch, keys)
        if token:
            ledger.mark_batch(spark, path, token)
        return Inserted(len(days), len(before.files), len(ask), False)
    finally:
        batch.unpersist()


def write_ema_rows(ema_rows: DataFrame, path: str, **how) -> Inserted:
    return insert_if_absent(ema_rows, path, EMA_TABLE_KEY, **how)


def write_advisories(advisories: DataFrame, path: str, **how) -> Inserted:
    """Advisories are stored with the message column named ``advice``."""
    return insert_if_absent(advisories.withColumnRenamed("message", "advice"), path, ADVISORY_TABLE_KEY, **how)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now: a compaction that ends while the rows are read changes nothing for them."""
    if not ledger.swaps(spark, path):
        return spark.read.parquet(path)
    return ledger.read_files(spark, path, ledger.day_files(spark, path, ledger.days_of(spark, path)))


def latest_times(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, latest) from the side table that the sink keeps; the table itself is not read."""
    return ledger.read_latest(spark, path)
