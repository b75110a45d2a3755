"""Tick views over the driver's tables.

* ``events_as_ticks``: the ``events`` table read as a tick feed (15 symbols, sub-second ticks).
* ``lineitem_as_ticks``: ``lineitem`` read as a feed with 1,500 symbols and day-grain ticks.

Both are plain projections over a Parquet scan, so Catalyst prunes the read to the columns a
query uses and pushes filters on ``trade_timestamp`` into the scan. Both carry ``seq``, the
arrival order used to break ties between ticks with the same trade time.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ticks import delay_ms
from ..schemas import REGIONS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def region_by_index(idx: Column) -> Column:
    """Region name from a 0-based index into the fixed region list."""
    return F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (idx % len(REGIONS)).cast("int") + 1)


def events_to_ticks(events: DataFrame) -> DataFrame:
    """Project an ``events``-shaped DataFrame (batch or stream) to ticks."""
    k = F.get_json_object("props", "$.k").cast("long")
    wall = F.timestamp_add("MILLISECOND", k, F.col("ts"))
    return events.select(
        F.concat(F.upper("event_type"), F.lit("."), region_by_index(F.col("user_id"))).alias("id"),
        F.when(F.col("event_type") == "error", "I").otherwise("E").alias("sec_type"),
        F.col("value").cast("string").alias("last"),
        F.col("ts").alias("trade_timestamp"),
        wall.alias("wallclock_timestamp"),
        delay_ms(wall, F.col("ts")).alias("delay"),
        F.col("event_id").alias("seq"),
    )


def events_as_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_ticks(read_table(spark, sf_dir, "events"))


LINEITEM_SYMBOLS = 500


def lineitem_as_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as ticks: symbol from part and supplier, unit price as the price, ship day as time.

    ``(l_orderkey, l_linenumber)`` is not unique in this table, so ``seq`` is the struct of all
    columns that make the tie-break total.
    """
    li = read_table(spark, sf_dir, "lineitem")
    price = F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2)
    return li.select(
        F.concat(F.lit("P"), (F.col("l_partkey") % LINEITEM_SYMBOLS).cast("string"), F.lit("."),
                 region_by_index(F.col("l_suppkey"))).alias("id"),
        F.lit("E").alias("sec_type"),
        price.cast("string").alias("last"),
        F.col("l_shipdate").alias("trade_timestamp"),
        F.col("l_shipdate").alias("wallclock_timestamp"),
        F.lit(0).cast("long").alias("delay"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("seq"),
    )
