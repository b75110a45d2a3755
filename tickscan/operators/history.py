"""History queries over the EMA and advisory tables, and the chart view port.

The reference answers "the last 100 minutes of share X" with two statements (latest row, then a
range). Here the latest time of each symbol comes from the side table that the sink keeps
(``latest_times``, a few rows for each symbol) if one is given, else from a partial aggregate over two
columns of the table. Each symbol's range becomes its days, one row for each, and joins the table on
symbol and ``trade_date``: partitions are pruned while the query runs, by the days themselves where Spark
broadcasts the ranges and by the first and last of them in any case. Building a plan runs no job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import advice_flag, clock_label, to_proto_ts
from ..schemas import (HISTORY_LOOKBACK_MINUTES, PARTITION_COLUMN, VIEWPORT_GRID_MINUTES, VIEWPORT_LEAD_MINUTES,
                       VIEWPORT_SPAN_MINUTES)


def _minutes(n: float) -> Column:
    return F.make_dt_interval(mins=F.lit(int(n))) if float(n).is_integer() else F.make_dt_interval(secs=F.lit(n * 60.0))


def _for_share(df: DataFrame, share: str | None) -> DataFrame:
    if share is None or share == "ALL":
        return df
    return df.where(F.col("symbol") == F.lit(share))


def _times(table: DataFrame, share: str | None, times: DataFrame | None) -> DataFrame:
    """(symbol, _latest), from the side table ``times`` (symbol, latest) if given."""
    if times is not None:
        return _for_share(times, share).select("symbol", F.col("latest").alias("_latest"))
    return _for_share(table, share).groupBy("symbol").agg(F.max("trade_timestamp").alias("_latest"))


def _in_ranges(table: DataFrame, ranges: DataFrame, low: str, high: str) -> DataFrame:
    """Rows of ``table`` from ``low`` to ``high`` (both inclusive) of their symbol's row in ``ranges``."""
    keys = ["symbol"]
    if PARTITION_COLUMN in table.columns:
        # the comparison also tells Spark that the ranges are worth pruning partitions by
        ranges = (ranges.where(F.col(low) <= F.col(high))
                  .withColumn(PARTITION_COLUMN, F.explode(F.sequence(F.to_date(low), F.to_date(high)))))
        ends = ranges.agg(F.min(PARTITION_COLUMN).alias("a"), F.max(PARTITION_COLUMN).alias("b"))
        table = table.where(F.col(PARTITION_COLUMN).between(ends.select("a").scalar(), ends.select("b").scalar()))
        keys.append(PARTITION_COLUMN)
    return table.join(ranges, keys).where(F.col("trade_timestamp").between(F.col(low), F.col(high)))


def latest(table: DataFrame, share: str | None = None, times: DataFrame | None = None) -> DataFrame:
    """Each symbol's latest row (the whole row); with ``times`` only their days are read."""
    if times is not None:
        return _in_ranges(_for_share(table, share), _times(table, share, times), "_latest", "_latest").select(*table.columns)
    t = _for_share(table, share)
    others = [c for c in t.columns if c != "symbol"]
    return (t.groupBy("symbol").agg(F.max_by(F.struct(*others), "trade_timestamp").alias("_r"))
             .select("symbol", *[F.col(f"_r.{c}").alias(c) for c in others]))


def _last_range(table: DataFrame, share: str | None, lookback_minutes: float, times: DataFrame | None) -> DataFrame:
    last = _times(table, share, times).withColumn("_first", F.col("_latest") - _minutes(lookback_minutes))
    return _in_ranges(_for_share(table, share), last, "_first", "_latest").drop("_first", "_latest")


def ema_history(ema_table: DataFrame, share: str | None = None,
                lookback_minutes: float = HISTORY_LOOKBACK_MINUTES, times: DataFrame | None = None) -> DataFrame:
    """EMA rows from (latest - lookback) to latest, both inclusive, per symbol, oldest first."""
    return (_last_range(ema_table, share, lookback_minutes, times)
            .select("symbol", "ema38", "ema100", "trade_timestamp")
            .orderBy("symbol", "trade_timestamp"))


def advisory_history(advisory_table: DataFrame, share: str | None = None,
                     lookback_minutes: float = HISTORY_LOOKBACK_MINUTES, times: DataFrame | None = None) -> DataFrame:
    """Advisories in the same look-back; ``advice`` read back as ``message``, with clock label and flag."""
    return (_last_range(advisory_table, share, lookback_minutes, times)
            .select("symbol", F.col("advice").alias("message"), "trade_timestamp",
                    clock_label("trade_timestamp").alias("clock"),
                    advice_flag(F.col("advice")).alias("flag"))
            .orderBy("symbol", "trade_timestamp"))


def history(kind: str, share: str | None, ema_table: DataFrame | None = None,
            advisory_table: DataFrame | None = None, tick_schema=None,
            lookback_minutes: float = HISTORY_LOOKBACK_MINUTES, spark=None) -> DataFrame:
    """Dispatch on a topic or kind name: ``*-ema`` -> EMA history, ``*-advisories`` -> advisories,
    anything else (ticks included) -> an empty result. Missing kind or share is an error."""
    if not kind or not share:
        raise ValueError("history needs both a kind and a share")
    if "-ema" in kind or kind == "ema":
        return ema_history(ema_table, share, lookback_minutes)
    if "-advisories" in kind or kind == "advisories":
        return advisory_history(advisory_table, share, lookback_minutes)
    if spark is None:
        base = ema_table if ema_table is not None else advisory_table
        spark = base.sparkSession
    from ..schemas import TICK
    return spark.createDataFrame([], tick_schema or TICK)


def as_messages(ema_table: DataFrame) -> DataFrame:
    """EMA rows in message form, trade time as ``{seconds, nanos}``."""
    return ema_table.select("symbol", "ema38", "ema100", to_proto_ts("trade_timestamp").alias("trade_ts"))


def _views(table: DataFrame, shift_minutes: int, share: str | None, times: DataFrame | None) -> DataFrame:
    """(symbol, view_start, view_end): one hour from 15 minutes before the latest row, moved."""
    start = F.col("_latest") - _minutes(VIEWPORT_LEAD_MINUTES) + _minutes(shift_minutes)
    views = _times(table, share, times).select("symbol", start.alias("view_start"))
    return views.withColumn("view_end", F.col("view_start") + _minutes(VIEWPORT_SPAN_MINUTES))


def viewport(ema_table: DataFrame, shift_minutes: int = 0, share: str | None = None, times: DataFrame | None = None) -> DataFrame:
    """Rows in each symbol's chart view: one hour from 15 minutes before its latest row, moved by
    ``shift_minutes``. Adds ``view_start`` and ``view_end``."""
    return _in_ranges(_for_share(ema_table, share), _views(ema_table, shift_minutes, share, times), "view_start", "view_end")


def time_grid(ema_table: DataFrame, shift_minutes: int = 0, share: str | None = None, times: DataFrame | None = None) -> DataFrame:
    """Axis ticks every 5 minutes inside each symbol's view port (both ends included)."""
    step = F.make_dt_interval(mins=F.lit(VIEWPORT_GRID_MINUTES))
    return _views(ema_table, shift_minutes, share, times).select(
        "symbol", F.explode(F.sequence("view_start", "view_end", step)).alias("grid_time"))


def history_plus_live(history_rows: DataFrame, live_rows: DataFrame,
                      key=("symbol", "trade_timestamp")) -> DataFrame:
    """History followed by live rows for one chart; where both have a row, the history's is kept."""
    return history_rows.unionByName(live_rows.join(history_rows.select(*key), list(key), "left_anti"))
