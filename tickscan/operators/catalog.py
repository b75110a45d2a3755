"""Symbol, region and topic catalogs and per-symbol counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ticks import region_of, topic_name
from ..schemas import TOPIC_KINDS, TOPIC_REPLICATION


def symbol_counts(ticks: DataFrame, key: str = "id") -> DataFrame:
    """Rows per symbol (partial counts map-side, so a hot symbol costs one row per task)."""
    return ticks.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n"))


def top_symbols(ticks: DataFrame, k: int = 10, key: str = "id") -> DataFrame:
    """The ``k`` symbols with most rows, rank 1 first; ties by symbol name.

    ``orderBy(...).limit(k)`` plans a TakeOrderedAndProject (a per-task top-k, then a final
    top-k of ``k * tasks`` rows); the rank is numbered over those ``k`` rows only.
    """
    top = symbol_counts(ticks, key).orderBy(F.desc("n"), F.asc("id")).limit(k)
    return top.withColumn("rank", F.row_number().over(W.orderBy(F.desc("n"), F.asc("id"))))


def regions(ticks: DataFrame) -> DataFrame:
    return ticks.select(region_of("id").alias("region")).where(F.col("region").isNotNull()).distinct()


def symbols(ticks: DataFrame, key: str = "id") -> DataFrame:
    return ticks.select(F.col(key).alias("symbol")).distinct()


def symbol_total(ticks: DataFrame, key: str = "id") -> DataFrame:
    return ticks.agg(F.count_distinct(key).alias("n_symbols"))


def catalog_topics(region_df: DataFrame) -> DataFrame:
    """Topic catalog: every region times every kind, with the kind's partition count."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(p).alias("partitions")) for k, p in TOPIC_KINDS])
    return (region_df.select("region", F.inline(kinds))
                     .select(topic_name(F.col("region"), F.col("kind")).alias("name"),
                             "region", "kind", "partitions",
                             F.lit(TOPIC_REPLICATION).alias("replication_factor")))
