"""Layer 3: the blocked EMA scan equals a sequential fold (brute force) on the driver's tables."""
import pandas as pd
import pytest

from conftest import SF_MID, SF_SMALL
from tickscan.operators.bars import bars
from tickscan.operators.clean import valid_ticks
from tickscan.operators.ema import ema
from tickscan.sources.tables import events_as_ticks, lineitem_as_ticks


def brute(pdf: pd.DataFrame, spans=(38, 100)):
    out = {}
    for sym, g in pdf.sort_values(["symbol", "w"]).groupby("symbol"):
        e = [0.0] * len(spans)
        for w, p in zip(g["w"], g["close"]):
            e = [p * 2 / (s + 1) + x * (1 - 2 / (s + 1)) for s, x in zip(spans, e)]
            out[(sym, w)] = e
    return out


@pytest.mark.parametrize("sf,window,bits", [(SF_SMALL, "1 hour", 6), (SF_MID, "1 minute", 6),
                                            (SF_SMALL, "1 minute", 2), (SF_SMALL, "1 hour", 1)])
def test_scan_matches_sequential(spark, sf, window, bits):
    b = bars(valid_ticks(events_as_ticks(spark, sf)), window)
    got = ema(b, bits=bits).select("symbol", "w", "ema38", "ema100").toPandas()
    ref = brute(b.select("symbol", "w", "close").toPandas())
    assert len(got) == len(ref)
    worst = max(max(abs(r.ema38 - ref[(r.symbol, r.w)][0]), abs(r.ema100 - ref[(r.symbol, r.w)][1]))
                for r in got.itertuples())
    assert worst < 1e-9


def test_scan_many_symbols(spark):
    b = bars(valid_ticks(lineitem_as_ticks(spark, SF_SMALL)), "1 day")
    got = ema(b, spans=(5, 20)).select("symbol", "w", "ema5", "ema20").toPandas()
    ref = brute(b.select("symbol", "w", "close").toPandas(), spans=(5, 20))
    worst = max(max(abs(r.ema5 - ref[(r.symbol, r.w)][0]), abs(r.ema20 - ref[(r.symbol, r.w)][1]))
                for r in got.itertuples())
    assert worst < 1e-9


def test_previous_values_are_lagged_ema(spark):
    b = bars(valid_ticks(events_as_ticks(spark, SF_SMALL)), "1 minute")
    e = ema(b, with_previous=True, bits=2).toPandas().sort_values(["symbol", "w"])
    for _, g in e.groupby("symbol"):
        prev = g["ema38"].shift(1).fillna(0.0).to_numpy()
        assert abs(prev - g["prev_ema38"].to_numpy()).max() < 1e-9


def test_first_close_and_position_match_sequential(spark):
    b = bars(valid_ticks(events_as_ticks(spark, SF_SMALL)), "1 minute")
    got = ema(b, seed="first_close", with_position=True, bits=2).select("symbol", "w", "ema38", "bar_no").toPandas()
    ref = {}
    for sym, g in b.select("symbol", "w", "close").toPandas().sort_values(["symbol", "w"]).groupby("symbol"):
        e = None
        for n, (w, p) in enumerate(zip(g["w"], g["close"]), start=1):
            e = p if e is None else p * 2 / 39 + e * (1 - 2 / 39)
            ref[(sym, w)] = (e, n)
    assert max(abs(r.ema38 - ref[(r.symbol, r.w)][0]) for r in got.itertuples()) < 1e-9
    assert all(r.bar_no == ref[(r.symbol, r.w)][1] for r in got.itertuples())
