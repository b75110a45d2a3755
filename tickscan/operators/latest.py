"""Latest price per symbol and the direction of its last move."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _order_cols(ticks: DataFrame):
    return ["trade_timestamp"] + (["seq"] if "seq" in ticks.columns else [])


def last_price(ticks: DataFrame, key: str = "id", price: str = "price") -> DataFrame:
    """Price and trade time of each symbol's latest tick (one partial aggregate, no sort)."""
    from .bars import _ordering
    ordering = _ordering(ticks, _order_cols(ticks))
    return (ticks.groupBy(F.col(key).alias("symbol"))
                 .agg(F.max_by(price, ordering).alias("last_price"),
                      F.max("trade_timestamp").alias("trade_timestamp")))


def price_direction(ticks: DataFrame, key: str = "id", price: str = "price") -> DataFrame:
    """``up`` / ``down`` / ``flat`` from the last two ticks of each symbol, ``single`` with one tick.

    Prices compare as numbers. ``row_number() <= 2`` lets Catalyst insert a WindowGroupLimit
    before the shuffle, so each task forwards at most two rows per symbol.
    """
    cols = _order_cols(ticks)
    w = W.partitionBy(F.col(key)).orderBy(*[F.desc(c) for c in cols])
    last2 = ticks.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2)
    agg = (last2.groupBy(F.col(key).alias("symbol"))
                .agg(F.max_by(price, F.when(F.col("_rn") == 1, 1).otherwise(0)).alias("last_price"),
                     F.min_by(price, F.when(F.col("_rn") == 1, 1).otherwise(0)).alias("previous_price"),
                     F.count(F.lit(1)).alias("_n")))
    direction = (F.when(F.col("_n") < 2, "single")
                  .when(F.col("last_price") > F.col("previous_price"), "up")
                  .when(F.col("last_price") < F.col("previous_price"), "down")
                  .otherwise("flat"))
    return agg.select("symbol", "last_price",
                      F.when(F.col("_n") >= 2, F.col("previous_price")).alias("previous_price"),
                      direction.alias("direction"))
