"""The message codec: bytes worked out by hand, round trips of any values, damaged records."""
import struct
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickscan.functions.wire import MESSAGES, decode_batch, encode_batch, from_wire, to_wire
from tickscan.sources.kafka import decode_kinds, flat_message, split_decoded, to_topic_frame

UTC = timezone.utc
KIND = {"text": pa.string(), "time": pa.timestamp("us", "UTC"), "int": pa.int64(), "double": pa.float64()}


def structs(rows, message):
    return pa.array(rows, pa.struct([(n, KIND[k]) for n, k in MESSAGES[message]]))


def varint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def by_hand(row, message):
    out = b""
    for k, (name, kind) in enumerate(MESSAGES[message], 1):
        v = row[name]
        if kind == "text" and v:
            out += varint(k << 3 | 2) + varint(len(v.encode())) + v.encode()
        elif kind == "int" and v:
            out += varint(k << 3) + varint(v)
        elif kind == "double" and struct.pack("<d", v) != bytes(8):
            out += varint(k << 3 | 1) + struct.pack("<d", v)
        elif kind == "time" and v is not None:
            us = (v - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)
            sub = b"".join(varint(i << 3) + varint(x) for i, x in ((1, us // 1_000_000), (2, us % 1_000_000 * 1000)) if x)
            out += varint(k << 3 | 2) + varint(len(sub)) + sub
    return out


TEXT = st.text(max_size=200)
TIME = st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1)).map(lambda d: d.replace(tzinfo=UTC)) | st.none()
TICK = st.fixed_dictionaries({"id": TEXT, "sec_type": TEXT, "last": TEXT, "trade_timestamp": TIME, "wallclock_timestamp": TIME,
                              "delay": st.integers(-2**63, 2**63 - 1)})
EMA = st.fixed_dictionaries({"symbol": TEXT, "ema38": st.floats(allow_nan=False), "ema100": st.floats(allow_nan=False), "trade_timestamp": TIME})


@settings(max_examples=80, deadline=None)
@given(st.lists(TICK, max_size=8), st.lists(EMA, max_size=8))
def test_round_trip(ticks, emas):
    for rows, message in ((ticks, "FinancialTick"), (emas, "EMAResult")):
        got = encode_batch(structs(rows, message), message)
        assert got.to_pylist() == [by_hand(r, message) for r in rows]
        assert decode_batch(got, message).to_pylist() == rows


def test_damaged_and_foreign():
    row = {"symbol": "A.FR", "trade_timestamp": datetime(2024, 1, 1, tzinfo=UTC), "message": "Buy!"}
    good = by_hand(row, "BuyAdvisory")
    cut = [good[:i] for i in range(1, len(good))]
    ends = (6, len(good) - 6)  # cut after a whole field: a shorter message, not a damaged one
    got = decode_batch(pa.array(cut, pa.binary()), "BuyAdvisory").to_pylist()
    assert [i + 1 for i, g in enumerate(got) if g is not None] == list(ends)
    unknown = good + varint(9 << 3) + varint(300) + varint(10 << 3 | 5) + b"abcd" + varint(11 << 3 | 1) + bytes(8) + varint(12 << 3 | 2) + varint(3) + b"xyz"
    bad = [b"\x0b", b"\xff" * 11, varint(1 << 3 | 2) + varint(2**63) + b"x", varint(1 << 3 | 2) + b"\x02\xc3\x28", b"\x00\x01"]
    got = decode_batch(pa.array([unknown, None, b"", *bad, good], pa.binary()), "BuyAdvisory").to_pylist()
    assert got[0] == row and got[-1] == row and got[1] is None and all(g is None for g in got[3:-1])
    assert got[2] == {"symbol": "", "trade_timestamp": None, "message": ""}
    assert decode_batch(pa.array([], pa.binary()), "BuyAdvisory").to_pylist() == []
    assert decode_batch(pa.array([b"x", good, good]).slice(1, 1), "BuyAdvisory").to_pylist() == [row]


def test_columns(spark):
    rows = spark.createDataFrame([("A.FR", 1.5, -2.0, datetime(2024, 1, 1, 10, 0, 0, 5)), ("B.NL", 0.0, 3.0, datetime(1969, 12, 31, 23, 59, 59, 250000))],
                                 "symbol string, ema38 double, ema100 double, trade_timestamp timestamp")
    frame = to_topic_frame(rows, binary=True).withColumn("topic", F.lit("FR-ema")).withColumn("kind", F.lit("ema"))
    frame = frame.union(frame.limit(1).withColumn("value", F.expr("substring(value, 1, 9)")))
    good, dead = split_decoded(decode_kinds(frame)["ema"])
    assert sorted(tuple(r) for r in flat_message(good).collect()) == sorted(tuple(r) for r in rows.collect())
    assert dead.count() == 1
    back = rows.select(from_wire(to_wire(F.struct(*rows.columns), "EMAResult"), "EMAResult").alias("m")).select("m.*")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in rows.collect())
