"""Catalog files: symbol list, topic list, region list (read and write)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """``{"symbols": [...]}`` -> one row per symbol."""
    return (spark.read.option("multiLine", "true").schema("symbols array<string>").json(path)
                 .select(F.explode("symbols").alias("symbol")))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """``[{"name", "partitions", "replicationFactor"}, ...]`` -> rows."""
    return (spark.read.option("multiLine", "true")
                 .schema("name string, partitions bigint, replicationFactor bigint").json(path)
                 .select("name", "partitions", F.col("replicationFactor").alias("replication_factor")))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated region list -> one row per region."""
    return (spark.read.text(path)
                 .select(F.explode(F.split("value", ",")).alias("region"))
                 .select(F.trim("region").alias("region")).where(F.col("region") != ""))


def write_symbols(symbols: DataFrame, path: str, col: str = "symbol") -> None:
    """One JSON document ``{"symbols": [...]}`` (sorted). The list is the instrument catalog, one
    entry per symbol, so it is gathered into a single row by design."""
    (symbols.agg(F.array_sort(F.collect_set(col)).alias("symbols"))
            .coalesce(1).write.mode("overwrite").json(path))


def write_topics(topics: DataFrame, path: str) -> None:
    """One JSON array document ``[{"name", "partitions", "replicationFactor"}, ...]`` (regions x kinds)."""
    item = F.struct("name", "partitions", F.col("replication_factor").alias("replicationFactor"))
    (topics.agg(F.to_json(F.array_sort(F.collect_list(item))).alias("value"))
           .coalesce(1).write.mode("overwrite").text(path))


def write_regions(regions: DataFrame, path: str) -> None:
    (regions.agg(F.concat_ws(",", F.array_sort(F.collect_set("region"))).alias("value"))
            .coalesce(1).write.mode("overwrite").text(path))
