"""Keyed state for the streaming EMA and crossover rule (``transformWithState``).

State per symbol is one row: the current EMA of every span (0 before the first bar). Each
micro-batch hands a symbol the bars the watermark closed in that batch; they are applied in
window order (batches themselves arrive in window order, because append mode only emits a window
once the watermark has passed its end). Every bar yields one output row with the EMAs after it and
the crossover message it triggers (or NULL).
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.ema import alpha, ema_col
from ..schemas import BUY, DEFAULT_SPANS, SELL


#: Name of the state variable, by which a checkpoint is read (``streaming/inspect.py``).
STATE_NAME = "ema"


def state_schema(spans=DEFAULT_SPANS) -> T.StructType:
    """A symbol's state: the EMA of each span and the number of bars."""
    return T.StructType([*[T.StructField(f"e{s}", T.DoubleType()) for s in spans], T.StructField("n", T.LongType())])


def output_schema(spans=DEFAULT_SPANS) -> T.StructType:
    return T.StructType([
        T.StructField("symbol", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("trade_timestamp", T.TimestampType()),
        T.StructField("close", T.DoubleType()),
        *[T.StructField(ema_col(s), T.DoubleType()) for s in spans],
        T.StructField("message", T.StringType()),
    ])


class EmaCrossoverProcessor(StatefulProcessor):
    """EMA of each span per symbol plus the fast/slow crossover of the first two spans."""

    def __init__(self, spans=DEFAULT_SPANS, seed: float | str = 0.0, ttl_ms: int | None = None,
                 min_bars: int = 0):
        self.spans = list(spans)
        self.seed = seed if seed == "first_close" else float(seed)
        self.ttl_ms = ttl_ms
        self.min_bars = min_bars

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(STATE_NAME, state_schema(self.spans), self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Take up a symbol where stored history left it: (symbol, e<span>..., n)."""
        row = initialState
        self.state.update((*[float(row[f"e{s}"]) for s in self.spans], int(row["n"])))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        bars = sorted(rows, key=lambda r: r["window_start"])
        if not bars:  # only an initial state
            return
        if self.state.exists():
            *cur, n = self.state.get()
            cur = list(cur)
        else:
            first = float(bars[0]["close"]) if bars and self.seed == "first_close" else self.seed
            cur, n = [first] * len(self.spans), 0
        fast, slow = 0, 1
        for r in bars:
            price = float(r["close"])
            prev = cur
            n += 1
            if n == 1 and self.seed == "first_close":
                cur = [price] * len(self.spans)  # exactly the close, as the formula gives in exact arithmetic
            else:
                cur = [price * alpha(s) + e * (1.0 - alpha(s)) for s, e in zip(self.spans, prev)]
            msg = None
            if cur[fast] > cur[slow] and prev[fast] <= prev[slow]:
                msg = BUY
            elif cur[fast] < cur[slow] and prev[fast] >= prev[slow]:
                msg = SELL
            if n < self.min_bars:
                msg = None
            out = {"symbol": r["symbol"], "window_start": r["window_start"], "window_end": r["window_end"],
                   "trade_timestamp": r["trade_timestamp"], "close": price}
            out.update({ema_col(s): e for s, e in zip(self.spans, cur)})
            out["message"] = msg
            yield Row(**out)
        if bars:
            self.state.update((*cur, n))

    def close(self) -> None:
        pass
