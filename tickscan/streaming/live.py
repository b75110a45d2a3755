"""Live views over streams: each symbol's last two ticks, and a chart's rows from history on.

``price_direction_stream`` keeps two ticks for each symbol as state, whatever has been seen: a late tick
takes the place that its trade time gives it, as in the batch query. A micro-batch hands a symbol its
ticks as pandas frames, of which the two latest are kept; one row goes out for each symbol of a batch.

``start_chart`` writes the stored rows of a share (or of all) first and then those of the live feed
that history does not have, each once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.ticks import instant
from ..operators.clean import valid_ticks
from ..operators.history import _for_share
from ..schemas import EMA_TABLE_KEY, LATENESS_BOUND

DIRECTION_SCHEMA = "symbol string, last_price double, previous_price double, direction string"
NO_SEQ = -(1 << 63)


class LastTwoTicks(StatefulProcessor):
    """(time, seq, price) of a symbol's latest tick and of the one before it, if there is one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last_two", "t1 long, s1 long, p1 double, t2 long, s2 long, p2 double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = []
        if self.state.exists():
            t1, s1, p1, t2, s2, p2 = self.state.get()
            held = [(t1, s1, p1)] + ([] if t2 is None else [(t2, s2, p2)])
        for frame in rows:
            two = frame.sort_values(["t", "s"]).tail(2)
            held += [(int(t), int(s), float(p)) for t, s, p in zip(two["t"], two["s"], two["price"])]
        held = sorted(held)[::-1][:2]
        if not held:
            return
        last, before = held[0], held[1] if len(held) > 1 else (None, None, None)
        self.state.update((*last, *before))
        p, q = last[2], before[2]
        direction = "single" if q is None else "up" if p > q else "down" if p < q else "flat"
        yield pd.DataFrame({"symbol": [key[0]], "last_price": [p], "previous_price": pd.array([q], "Float64"), "direction": [direction]})

    def close(self) -> None:
        pass


def price_direction_stream(ticks: DataFrame) -> DataFrame:
    """Update rows (symbol, last_price, previous_price, direction) of a tick stream."""
    v = valid_ticks(ticks)
    v = v.select(F.col("id").alias("symbol"), F.unix_micros(instant("trade_timestamp")).alias("t"),
                 F.coalesce(F.col("seq").cast("long"), F.lit(NO_SEQ)).alias("s"), "price")
    return v.groupBy("symbol").transformWithStateInPandas(LastTwoTicks(), DIRECTION_SCHEMA, "Update", "None")


def by_batch(path: str):
    """``foreachBatch`` function: each batch in a folder of its own, so that a repeated one replaces itself."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def start_chart(live: DataFrame, history: DataFrame, out_path: str, checkpoint: str, share: str | None = None,
                bound: str = LATENESS_BOUND, key=EMA_TABLE_KEY, processing_time: str = "5 seconds") -> StreamingQuery:
    """Rows for the chart of ``share`` (None or ``ALL``: all) under ``out_path``, by batch: batch 0 begins
    with the rows of ``history``; live rows follow, without those that history has (its values stay) and
    without repeats within ``bound``."""
    key = list(key)
    stored = _for_share(history, share)
    rows = (_for_share(live, share).withWatermark("trade_timestamp", bound).dropDuplicatesWithinWatermark(key)
            .join(stored.select(*key), key, "left_anti"))

    def write(df: DataFrame, batch_id: int) -> None:
        out = df.select(*live.columns)
        if batch_id == 0:
            out = stored.select(*live.columns).unionByName(out)
        out.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(processingTime=processing_time).start())
