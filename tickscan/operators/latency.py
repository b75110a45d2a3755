"""Latency statistics and topic routing.

Exact percentiles: ``percentile_disc``, one count for each distinct delay (whole milliseconds) kept
for all percentiles together and aggregated partially in every task, so what a group sends to its
reducer is bounded by the distinct delays, not by its rows, and no window runs over a group.

Sketches: one KLL quantile sketch for each group and day, a few kilobytes whatever the rows. Stored
sketches merge over any range of days and groups without the messages; a quantile read from one is
off by at most ``RANK_ERROR`` of the rows in rank (the sketch's own figure at 99 % confidence for
``SKETCH_K`` is a third of that).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import delay_ms, region_of, topic_kind

PERCENTILES = (0.5, 0.95, 0.99)
SKETCH_K = 800
RANK_ERROR = 0.01


def latency_stats(ticks: DataFrame, group_cols=("region",), value: str = "delay",
                  percentiles=PERCENTILES) -> DataFrame:
    """Per group: count, mean, min, max and nearest-rank percentiles of ``value``.

    Percentile ``q`` is the smallest value whose running count reaches ``q * n`` (nearest rank).
    """
    group_cols = list(group_cols)
    src = ticks
    if "region" in group_cols and "region" not in ticks.columns:
        src = ticks.withColumn("region", region_of("id"))
    src = src.where(F.col(value).isNotNull())
    aggs = [F.count(F.lit(1)).alias("n"), F.round(F.sum(value) / F.count(F.lit(1)), 6).alias("avg_delay"),
            F.min(value).alias("min_delay"), F.max(value).alias("max_delay")]
    points = ", ".join(f"{q}D" for q in percentiles)
    aggs.append(F.expr(f"percentile_disc(array({points})) WITHIN GROUP (ORDER BY `{value}`)").alias("_p"))
    named = [F.col("_p")[i].cast(src.schema[value].dataType).alias(_name(q)) for i, q in enumerate(percentiles)]
    return src.groupBy(*group_cols).agg(*aggs).select("*", *named).drop("_p")


def _name(q: float) -> str:
    return f"p{int(round(q * 100))}_delay"


def message_latency(messages: DataFrame, arrival: str = "benchmark_timestamp", trade: str = "trade_timestamp") -> DataFrame:
    """Messages of any kind (topic, trade and arrival time) with region, kind, day and delay in ms."""
    return (route_kind(messages).withColumn("region", F.substring_index("topic", "-", 1))
            .withColumn("day", F.to_date(arrival)).withColumn("delay", delay_ms(arrival, trade)))


def latency_sketches(messages: DataFrame, group_cols=("region", "kind", "day"), value: str = "delay", k: int = SKETCH_K) -> DataFrame:
    """One row for each group: n and a sketch of ``value`` that :func:`merge_sketches` can combine."""
    src = messages.where(F.col(value).isNotNull())
    return src.groupBy(*group_cols).agg(F.count("*").alias("n"), F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, group_cols=("region", "kind")) -> DataFrame:
    """Stored sketches combined: a partial aggregate over rows of a few kilobytes."""
    return sketches.groupBy(*group_cols).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketch_percentiles(sketches: DataFrame, percentiles=PERCENTILES) -> DataFrame:
    return sketches.select(*[c for c in sketches.columns if c != "sketch"],
                           *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(_name(q)) for q in percentiles])


def route_kind(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """Add ``kind`` (``ticks``/``ema``/``advisories``/``unknown``) from the topic name."""
    return messages.withColumn("kind", topic_kind(topic))


def split_by_kind(messages: DataFrame, topic: str = "topic") -> dict[str, DataFrame]:
    routed = route_kind(messages, topic)
    return {k: routed.where(F.col("kind") == k) for k in ("ticks", "ema", "advisories", "unknown")}
