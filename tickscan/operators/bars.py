"""Event-time price bars (tumbling windows).

A bar is the last price of a symbol within one ``[start, end)`` window, with the trade time of
that last tick. ``max_by`` is an incremental aggregate, so Catalyst plans a partial aggregate
before the shuffle: a hot symbol's ticks are pre-reduced map-side and the shuffle key
``(symbol, window)`` spreads its bars over all reducers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ticks import instant, whole_units

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000,
}


def duration_us(text: str | None) -> int:
    """Microseconds of a duration such as ``"1 minute"``, ``"7 days"`` or ``"90 seconds"``."""
    if not text:
        return 0
    total = 0
    for num, unit in re.findall(r"(-?\d+)\s*([a-zA-Z]+)", text):
        u = unit.lower().rstrip("s")
        if u not in _UNITS_US:
            raise ValueError(f"unsupported duration unit in {text!r}")
        total += int(num) * _UNITS_US[u]
    if total == 0 and text.strip() not in ("0", "0 seconds"):
        raise ValueError(f"cannot parse duration {text!r}")
    return total


def window_index(ts, window: str, offset: str | None = None) -> Column:
    """0-based index of the tumbling window holding ``ts`` (window ``k`` starts at ``offset + k*size``)."""
    return whole_units(F.unix_micros(instant(ts)) - F.lit(duration_us(offset)), duration_us(window))


def _ordering(df: DataFrame, order_cols) -> Column:
    """The "last tick" ordering: ``trade_timestamp`` then ``seq``.

    A NULL ``seq`` orders before all others. With an integer ``seq`` the pair is packed exactly into one ``DECIMAL(38,0)``
    (``micros * 10^20 + seq + 2^63``: micros stay below 10^18 in magnitude, the shifted seq below
    2^64 < 10^20), which keeps ``max_by`` in a code-generated hash aggregate. A struct ordering
    (e.g. a multi-column ``seq``) makes Spark sort every task's rows instead.
    """
    cols = list(order_cols) if order_cols else ["trade_timestamp"] + (["seq"] if "seq" in df.columns else [])
    if len(cols) == 1:
        return F.col(cols[0])
    if (len(cols) == 2 and isinstance(df.schema[cols[1]].dataType, T.IntegralType)
            and isinstance(df.schema[cols[0]].dataType, (T.TimestampType, T.TimestampNTZType))):
        seq = f"coalesce(CAST(`{cols[1]}` AS DECIMAL(38,0)), CAST('-9223372036854775808' AS DECIMAL(38,0)))"
        return F.expr(f"CAST(CAST(unix_micros(CAST(`{cols[0]}` AS TIMESTAMP)) AS DECIMAL(38,0)) "
                      f"* CAST('100000000000000000000' AS DECIMAL(38,0)) "
                      f"+ ({seq} + CAST('9223372036854775808' AS DECIMAL(38,0))) "
                      f"AS DECIMAL(38,0))")
    return F.struct(*cols)


def bars(ticks: DataFrame, window: str = "1 minute", offset: str | None = None,
         key: str = "id", price: str = "price", order_cols=None) -> DataFrame:
    """Per ``(symbol, window)``: close (price of the last tick), its trade time and tick count.

    "Last" is the greatest ``order_cols`` (default ``trade_timestamp`` then ``seq``), which makes
    the close deterministic when ticks share a trade time. Works on batch and streaming input; for a
    stream put the watermark on ``trade_timestamp`` first.

    Output: ``symbol, window_start, window_end, w, close, trade_timestamp, ticks`` where ``w`` is
    the window index used by the EMA scan.
    """
    ordering = _ordering(ticks, order_cols)
    aggs = [F.max_by(price, ordering).alias("close"),
            F.max("trade_timestamp").alias("trade_timestamp"),
            F.count(F.lit(1)).alias("ticks")]
    if ticks.isStreaming:
        # Streams group by the window struct: the watermark then closes and evicts windows.
        win = F.window("trade_timestamp", window, window, offset) if offset else F.window("trade_timestamp", window)
        out = ticks.groupBy(F.col(key).alias("symbol"), win.alias("window")).agg(*aggs)
        return out.select("symbol",
                          F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"),
                          window_index(F.col("window.start"), window, offset).alias("w"),
                          "close", "trade_timestamp", "ticks")
    # Batch groups by the window index (a long key hashes faster than the window struct); the
    # window bounds are rebuilt from it after the aggregate, in the source timestamp type.
    size, off = duration_us(window), duration_us(offset)
    out = ticks.groupBy(F.col(key).alias("symbol"),
                        window_index(F.col("trade_timestamp"), window, offset).alias("w")).agg(*aggs)
    ts_type = ticks.schema["trade_timestamp"].dataType
    start = F.timestamp_micros(F.col("w") * F.lit(size) + F.lit(off))
    end = F.timestamp_micros(F.col("w") * F.lit(size) + F.lit(off + size))
    return out.select("symbol", start.cast(ts_type).alias("window_start"), end.cast(ts_type).alias("window_end"),
                      "w", "close", "trade_timestamp", "ticks")
