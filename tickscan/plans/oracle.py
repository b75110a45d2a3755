"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Written from the semantics, not from the Spark code: the EMA is a recursive CTE that steps one
bar at a time exactly as the reference formula does, windows are integer arithmetic on epoch
microseconds. Tables ``events`` etc. are views registered by the caller.
"""

from __future__ import annotations

from ..operators.bars import duration_us
from ..schemas import REGIONS

_REGION_LIST = "[" + ", ".join(f"'{r}'" for r in REGIONS) + "]"

TICKS = f"""ticks AS (
  SELECT upper(event_type) || '.' || ({_REGION_LIST})[user_id % 3 + 1] AS id,
         CASE WHEN event_type = 'error' THEN 'I' ELSE 'E' END AS sec_type,
         CAST(value AS VARCHAR) AS last,
         ts AS trade_timestamp,
         ts + to_milliseconds(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS wallclock_timestamp,
         epoch_us(ts + to_milliseconds(CAST(json_extract_string(props, '$.k') AS BIGINT))) // 1000 - epoch_us(ts) // 1000 AS delay,
         event_id AS seq
  FROM events)"""

VTICKS = """vticks AS (
  SELECT * FROM (
    SELECT *, nullif(split_part(id, '.', 1), '') AS share, nullif(split_part(id, '.', 2), '') AS region,
           TRY_CAST(last AS DOUBLE) AS price
    FROM ticks)
  WHERE share IS NOT NULL AND region IS NOT NULL AND trade_timestamp IS NOT NULL AND price IS NOT NULL)"""

BASE = TICKS + ",\n" + VTICKS

# lineitem read as ticks; the unit price is rounded as Spark rounds a double: its shortest decimal
# form, half up (via DECIMAL), so x.xx5 quotients round the same way in both engines
LI_TICKS = f"""ticks AS (
  SELECT 'P' || CAST(l_partkey % 500 AS VARCHAR) || '.' || ({_REGION_LIST})[l_suppkey % 3 + 1] AS id,
         'E' AS sec_type,
         CAST(round(CAST(CAST(l_extendedprice / l_quantity AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS px,
         CAST(CAST(round(CAST(CAST(l_extendedprice / l_quantity AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS VARCHAR) AS last,
         l_shipdate AS trade_timestamp, l_shipdate AS wallclock_timestamp, CAST(0 AS BIGINT) AS delay,
         (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq
  FROM lineitem)"""

LI_BASE = LI_TICKS + ",\n" + VTICKS.replace("TRY_CAST(last AS DOUBLE) AS price", "px AS price")


def bars_cte(window: str, offset: str | None = None, name: str = "bars", src: str = "vticks") -> str:
    size, off = duration_us(window), duration_us(offset)
    idx = f"((epoch_us(trade_timestamp) - {off}) // {size})"
    return f"""{name} AS (
  SELECT id AS symbol,
         make_timestamp({idx} * {size} + {off}) AS window_start,
         make_timestamp({idx} * {size} + {off} + {size}) AS window_end,
         arg_max(price, (trade_timestamp, seq)) AS close,
         max(trade_timestamp) AS trade_timestamp,
         count(*) AS ticks
  FROM {src} GROUP BY 1, 2, 3)"""


def ema_ctes(spans=(38, 100), bars: str = "bars", name: str = "emas") -> str:
    """Recursive EMA: ``e_n = p_n * a + e_{n-1} * (1 - a)`` from 0, plus the previous values."""
    first = ", ".join(f"close * (2.0::DOUBLE / {s + 1}.0) AS e{s}, 0.0::DOUBLE AS p{s}" for s in spans)
    step = ", ".join(f"n.close * (2.0::DOUBLE / {s + 1}.0) + r.e{s} * (1.0 - 2.0::DOUBLE / {s + 1}.0), r.e{s}"
                     for s in spans)
    return f"""nb AS (
  SELECT symbol, window_start, window_end, trade_timestamp, close,
         row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS rn
  FROM {bars}),
{name} AS (
  SELECT symbol, rn, window_start, window_end, trade_timestamp, close, {first} FROM nb WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.rn, n.window_start, n.window_end, n.trade_timestamp, n.close, {step}
  FROM {name} r JOIN nb n ON n.symbol = r.symbol AND n.rn = r.rn + 1)"""


def trend_with(window: str, spans=(38, 100), offset: str | None = None, base: str = BASE) -> str:
    """``WITH RECURSIVE`` head defining ticks, vticks, bars, nb, emas and advs (crossovers)."""
    f, s = min(spans[:2]), max(spans[:2])
    advs = f"""advs AS (
  SELECT symbol, window_start, window_end, trade_timestamp,
         CASE WHEN e{f} > e{s} AND p{f} <= p{s} THEN 'Buy!'
              WHEN e{f} < e{s} AND p{f} >= p{s} THEN 'Sell!' END AS message
  FROM emas
  WHERE (e{f} > e{s} AND p{f} <= p{s}) OR (e{f} < e{s} AND p{f} >= p{s}))"""
    return "WITH RECURSIVE " + ",\n".join([base, bars_cte(window, offset), ema_ctes(spans), advs]) + "\n"


def with_base(*ctes: str) -> str:
    return "WITH " + ",\n".join([BASE, *ctes]) + "\n"
