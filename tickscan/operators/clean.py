"""Tick checking: split a tick feed into valid ticks and a quarantine with a reason.

The reference engine drops ticks without date/time, crashes on an id without a region and fails
the job on price text that is not a number; here every such row is kept in a quarantine
DataFrame with its reason, and the counts feed the ingest quality report. All of it is a
row-wise projection plus two filters over the same scan: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import price_of, region_of, share_of
from ..schemas import VALID_ID_PATTERN


def id_ok(id_col="id"):
    """True when the id has a non-empty share and region token (one pattern test, one reference to
    ``id``, so a filter pushed into the scan does not rebuild a derived id several times)."""
    return F.coalesce(F.col(id_col).rlike(VALID_ID_PATTERN), F.lit(False))


def checked(ticks: DataFrame) -> DataFrame:
    """Add ``share``, ``region``, ``price`` and ``reason`` (NULL for a valid tick)."""
    out = ticks.select("*", share_of("id").alias("share"), region_of("id").alias("region"),
                       price_of("last").alias("price"))
    reason = (F.when(~id_ok(), F.lit("bad_id"))
               .when(F.col("trade_timestamp").isNull(), F.lit("bad_timestamp"))
               .when(F.col("price").isNull(), F.lit("bad_price")))
    return out.withColumn("reason", reason)


def valid_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks that pass all checks, with ``share``, ``region`` and ``price`` added.

    The filter is written on the input columns so that it stays cheap wherever Catalyst pushes it
    (into the scan); the derived columns are computed once, after it."""
    cond = id_ok() & F.col("trade_timestamp").isNotNull() & price_of("last").isNotNull()
    return ticks.where(cond).select("*", share_of("id").alias("share"), region_of("id").alias("region"),
                                    price_of("last").alias("price"))


def quarantine(ticks: DataFrame) -> DataFrame:
    """Ticks that fail a check, with the first failing ``reason``."""
    return checked(ticks).where(F.col("reason").isNotNull())


def start_align(ticks: DataFrame, start) -> DataFrame:
    """Ticks strictly after ``start`` (a timestamp or its text); pushed into a Parquet scan."""
    dtype = ticks.schema["trade_timestamp"].dataType
    return ticks.where(F.col("trade_timestamp") > F.lit(start).cast(dtype))


def region_job(ticks: DataFrame, region: str) -> DataFrame:
    """The ticks one regional job sees (region taken from the id)."""
    return ticks.where(region_of("id") == F.lit(region))


def ingest_quality(ticks: DataFrame) -> DataFrame:
    """Per region: ticks sent on and ticks skipped, by reason (region NULL for unreadable ids)."""
    c = checked(ticks)
    return (c.groupBy("region")
             .agg(F.count_if(F.col("reason").isNull()).alias("sent"),
                  F.count_if(F.col("reason").isNotNull()).alias("skipped"),
                  F.count_if(F.col("reason") == "bad_id").alias("bad_id"),
                  F.count_if(F.col("reason") == "bad_timestamp").alias("bad_timestamp"),
                  F.count_if(F.col("reason") == "bad_price").alias("bad_price")))
