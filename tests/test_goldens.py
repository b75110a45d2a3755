"""Layer 1: hand-computed goldens of the EMA formula and the crossover rule (FIXTURES section 4)."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickscan.operators.ema import crossovers, ema
from tickscan.streaming.state import EmaCrossoverProcessor

T0 = datetime(2024, 1, 1)


def bars_of(spark, closes, symbol="AAA.FR"):
    rows = [(symbol, i, float(p), T0 + timedelta(minutes=i)) for i, p in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, w long, close double, trade_timestamp timestamp")


def batch_result(spark, closes, bits=6):
    e = ema(bars_of(spark, closes), with_previous=True, bits=bits)
    adv = {r["w"]: r["message"] for r in crossovers(e).collect()}
    out = {r["w"]: (round(r["ema38"], 6), round(r["ema100"], 6)) for r in e.collect()}
    return out, adv


class FakeState:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v


class FakeHandle:
    def getValueState(self, name, schema, ttl=None):
        return FakeState()


def stream_result(closes, batch_size=7):
    from pyspark.sql import Row
    p = EmaCrossoverProcessor()
    p.init(FakeHandle())
    rows = [Row(symbol="AAA.FR", window_start=T0 + timedelta(minutes=i), window_end=T0 + timedelta(minutes=i + 1),
                trade_timestamp=T0 + timedelta(minutes=i), close=float(c)) for i, c in enumerate(closes)]
    out, adv = {}, {}
    for start in range(0, len(rows), batch_size):
        chunk = list(reversed(rows[start:start + batch_size]))  # any order inside a micro-batch
        for r in p.handleInputRows(("AAA.FR",), iter(chunk), None):
            i = int((r["window_start"] - T0).total_seconds() // 60)
            out[i] = (round(r["ema38"], 6), round(r["ema100"], 6))
            if r["message"]:
                adv[i] = r["message"]
    return out, adv


CASES = [
    ([100, 110, 90], {0: (5.128205, 1.980198), 1: (10.506246, 4.119204), 2: (14.582849, 5.819814)}, {0: "Buy!"}),
    ([100] + [0] * 40, {29: (1.114145, 1.108688), 30: (1.05701, 1.086734)}, {0: "Buy!", 30: "Sell!"}),
    ([0, 5], {0: (0.0, 0.0), 1: (0.25641, 0.09901)}, {1: "Buy!"}),
    ([-5], {0: (-0.25641, -0.09901)}, {0: "Sell!"}),
    ([100] * 300, {299: (99.999986, 99.752174)}, {0: "Buy!"}),
]


@pytest.mark.parametrize("closes,values,advice", CASES)
def test_batch_goldens(spark, closes, values, advice):
    out, adv = batch_result(spark, closes)
    for i, v in values.items():
        assert out[i] == pytest.approx(v, abs=1e-6)
    assert adv == advice


@pytest.mark.parametrize("closes,values,advice", CASES)
def test_batch_goldens_deep_levels(spark, closes, values, advice):
    # blocks of 2 bars force several fold levels even on short histories
    out, adv = batch_result(spark, closes, bits=1)
    for i, v in values.items():
        assert out[i] == pytest.approx(v, abs=1e-6)
    assert adv == advice


@pytest.mark.parametrize("closes,values,advice", CASES)
def test_stream_goldens(closes, values, advice):
    out, adv = stream_result(closes)
    for i, v in values.items():
        assert out[i] == pytest.approx(v, abs=1e-6)
    assert adv == advice


def test_first_close_seed_and_min_bars(spark):
    closes = [100, 110, 90, 95]
    e = ema(bars_of(spark, closes), seed="first_close", with_previous=True, with_position=True, bits=1)
    got = {r["w"]: (round(r["ema38"], 6), r["bar_no"]) for r in e.collect()}
    assert got[0] == (100.0, 1) and got[1] == (round(100 + 10 * 2 / 39, 6), 2) and got[3][1] == 4
    adv = {r["w"]: r["message"] for r in crossovers(e).collect()}
    assert adv == {1: "Buy!", 2: "Sell!"}                      # no cold-start advice at bar 1
    assert {r["w"] for r in crossovers(e, min_bars=3).collect()} == {2}
    # the stream processor agrees
    p = EmaCrossoverProcessor(seed="first_close")
    p.init(FakeHandle())
    from pyspark.sql import Row
    rows = [Row(symbol="A", window_start=T0 + timedelta(minutes=i), window_end=T0, trade_timestamp=T0, close=float(c))
            for i, c in enumerate(closes)]
    out = list(p.handleInputRows(("A",), iter(rows[:2]), None)) + list(p.handleInputRows(("A",), iter(rows[2:]), None))
    assert [round(r["ema38"], 6) for r in out] == [got[i][0] for i in range(4)]
    assert [r["message"] for r in out] == [None, "Buy!", "Sell!", None]
