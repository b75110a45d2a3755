"""The analytics job as one declarative plan: ticks -> bars -> EMAs -> advisories.

Batch form of the streaming job: the same operators and, inside each block of bars, the same
recurrence in the same order. The blocks are written once to the shared folder
(``spark.checkpoint.dir``) and read by both passes of the EMA scan; the fold depth comes from their
range. ``levels="static"`` fixes it from the window size over a wide horizon instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.bars import bars as make_bars, duration_us
from ..operators.clean import valid_ticks
from ..operators.ema import BLOCK_BITS, crossovers, ema, ema_col, levels_for
from ..schemas import DEFAULT_SPANS, DEFAULT_WINDOW


@dataclass
class Trend:
    bars: DataFrame
    emas: DataFrame
    advisories: DataFrame


# Time range the default plan covers: window indices of these instants bound the fold levels, so
# no job has to look at the data to size the plan (``levels="static"``).
HORIZON = ("1900-01-01", "2200-01-01")


def static_levels(window: str, offset: str | None = None, horizon=HORIZON) -> int:
    """Fold levels that keep every top-level group at <= 64 nodes for any data inside ``horizon``."""
    from datetime import datetime, timezone
    size, off = duration_us(window), duration_us(offset)
    lo, hi = (int(datetime.fromisoformat(h).replace(tzinfo=timezone.utc).timestamp() * 1_000_000) for h in horizon)
    return levels_for((lo - off) // size, (hi - off) // size, BLOCK_BITS)


def trend(ticks: DataFrame, window: str = DEFAULT_WINDOW, spans=DEFAULT_SPANS, offset: str | None = None,
          levels: int | str | None = None, validate: bool = True, order_cols=None,
          materialize: bool = True, seed: float | str = 0.0, min_bars: int = 0) -> Trend:
    """Bars, EMAs (with previous values) and crossover advisories of a batch tick feed."""
    spans = list(spans)
    t = valid_ticks(ticks) if validate else ticks
    b = make_bars(t, window, offset, order_cols=order_cols)
    if levels == "data":
        levels = None
    elif levels == "static":
        levels = static_levels(window, offset)
    e = ema(b, spans, levels=levels, seed=seed, with_previous=True, with_position=min_bars > 0, materialize=materialize)
    fast, slow = ema_col(min(spans[:2])), ema_col(max(spans[:2]))
    adv = crossovers(e, fast, slow, f"prev_{fast}", f"prev_{slow}", min_bars=min_bars)
    return Trend(b, e, adv)


def ema_rows(emas: DataFrame, spans=DEFAULT_SPANS) -> DataFrame:
    """EMA result rows as stored: ``symbol, ema<spans>..., trade_timestamp``."""
    return emas.select("symbol", *[ema_col(s) for s in spans], "trade_timestamp")


def advisory_rows(advisories: DataFrame) -> DataFrame:
    return advisories.select("symbol", "trade_timestamp", "message")
