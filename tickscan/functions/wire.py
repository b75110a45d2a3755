"""The three topic messages in protobuf's wire form, encoded and decoded a batch at a time.

For sessions without Spark's protobuf functions. Both directions are Arrow functions that work on
whole columns: all messages of a batch are read in step, one field of each at a time, by a varint scan
over the batch's bytes; encoded fields are laid into one buffer by offsets.

Text, 64-bit integers, doubles and timestamps (a nested message of seconds and nanos) are known, which is what the
messages use. Default values are left out when encoding and come back as such (a missing timestamp as
null). Unknown fields are skipped, of repeated fields the last counts. A message that can't be read
(cut short, a length beyond its end, an unknown wire type, text that isn't UTF-8) decodes to null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields of each message in order of their numbers (from 1); fixed by the message definition.
MESSAGES = {
    "FinancialTick": [("id", "text"), ("sec_type", "text"), ("last", "text"), ("trade_timestamp", "time"),
                      ("wallclock_timestamp", "time"), ("delay", "int")],
    "EMAResult": [("symbol", "text"), ("ema38", "double"), ("ema100", "double"), ("trade_timestamp", "time")],
    "BuyAdvisory": [("symbol", "text"), ("trade_timestamp", "time"), ("message", "text")],
}
_SPARK = {"text": T.StringType(), "time": T.TimestampType(), "int": T.LongType(), "double": T.DoubleType()}
_ARROW = {"text": pa.string(), "time": pa.timestamp("us", "UTC"), "int": pa.int64(), "double": pa.float64()}
_WIRE = {"text": 2, "time": 2, "int": 0, "double": 1}
VARINT_BYTES = 10


def message_schema(message: str) -> T.StructType:
    return T.StructType([T.StructField(name, _SPARK[kind]) for name, kind in MESSAGES[message]])


# -- reading ----------------------------------------------------------------------------------

def _varints(buf: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, places after them, whether whole) of the varints that start at ``at``."""
    value, ok = np.zeros(len(at), np.uint64), np.zeros(len(at), bool)
    at, going = at.copy(), np.ones(len(at), bool)
    for k in range(VARINT_BYTES):
        going &= at < end
        if not going.any():
            break
        byte = buf[np.where(going, at, 0)].astype(np.uint64)
        value = np.where(going, value | ((byte & np.uint64(0x7F)) << np.uint64(7 * k)), value)
        at = at + going
        done = going & (byte < 0x80)
        ok |= done
        going &= ~done
    return value, at, ok


def _fields(buf: np.ndarray, at: np.ndarray, end: np.ndarray):
    """Yields, in step, (rows, field numbers, wire types, values, begins, ends); last the rows' health."""
    healthy = np.ones(len(at), bool)
    at = at.copy()
    while True:
        rows = np.flatnonzero(healthy & (at < end))
        if not len(rows):
            break
        tag, p, ok = _varints(buf, at[rows], end[rows])
        wire, number = (tag & np.uint64(7)).astype(np.int64), (tag >> np.uint64(3)).astype(np.int64)
        value, q, whole = _varints(buf, p, end[rows])
        size = np.minimum(value, np.uint64(1 << 40)).astype(np.int64)
        begin = np.where(wire == 2, q, p)
        stop = np.select([wire == 0, wire == 1, wire == 2, wire == 5], [q, p + 8, q + size, p + 4], p)
        ok &= np.isin(wire, (0, 1, 2, 5)) & (number > 0) & (stop <= end[rows]) & (whole | (wire == 1) | (wire == 5))
        healthy[rows[~ok]] = False
        at[rows] = stop
        yield rows[ok], number[ok], wire[ok], value[ok], begin[ok], stop[ok]
    yield healthy


def _texts(buf: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Slices of the buffer as text, and which of them are UTF-8."""
    size = stop - begin
    off = np.concatenate([[0], np.cumsum(size)])
    data = buf[np.repeat(begin - off[:-1], size) + np.arange(off[-1])]
    raw = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)])
    try:
        return raw.cast(pa.large_string()).cast(pa.string()), np.ones(len(begin), bool)
    except pa.ArrowInvalid:
        out = []
        for v in raw.to_pylist():
            try:
                out.append(v.decode())
            except UnicodeDecodeError:
                out.append(None)
        return pa.array(out, pa.string()), np.array([v is not None for v in out])


def decode_batch(values: pa.Array, message: str) -> pa.Array:
    """Message bytes to structs; null for null and unreadable ones."""
    values = values.cast(pa.large_binary())
    n = len(values)
    _, off, data = values.buffers()
    off = np.frombuffer(off, np.int64)[values.offset:values.offset + n + 1] if n else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
    begin, end = off[:-1], off[1:]
    kinds = MESSAGES[message]
    found = {k: (np.zeros(n, np.uint64), np.full(n, -1), np.zeros(n, np.int64)) for k in range(1, len(kinds) + 1)}
    healthy = np.ones(n, bool)
    for step in _fields(buf, begin, end):
        if isinstance(step, np.ndarray):
            healthy = step
            break
        rows, number, wire, value, a, b = step
        for k, (v, at, to) in found.items():
            hit = (number == k) & (wire == _WIRE[kinds[k - 1][1]])
            v[rows[hit]], at[rows[hit]], to[rows[hit]] = value[hit], a[hit], b[hit]
    columns = []
    for k, (_, kind) in enumerate(kinds, 1):
        v, at, to = found[k]
        held = np.flatnonzero(at >= 0)
        if kind == "int":
            columns.append(pa.array(v.view(np.int64)))
        elif kind == "double":
            x = np.zeros(n)
            x[held] = buf[at[held][:, None] + np.arange(8)].copy().view("<f8")[:, 0] if len(held) else 0
            columns.append(pa.array(x))
        elif kind == "text":
            text, good = _texts(buf, np.where(at >= 0, at, 0), np.where(at >= 0, to, 0))
            healthy &= good
            columns.append(text)
        else:
            seconds, nanos, sound = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.ones(n, bool)
            for step in _fields(buf, at[held], to[held]):
                if isinstance(step, np.ndarray):
                    sound[held[~step]] = False
                    break
                rows, number, wire, value, _, _ = step
                for part, target in ((1, seconds), (2, nanos)):
                    hit = (number == part) & (wire == 0)
                    target[held[rows[hit]]] = value[hit]
            healthy &= sound
            us = seconds.view(np.int64) * 1_000_000 + nanos.view(np.int64) // 1000
            columns.append(pa.array(us, pa.int64(), mask=at < 0).cast(_ARROW["time"]))
    null = ~healthy | values.is_null().to_numpy(zero_copy_only=False)
    return pa.StructArray.from_arrays(columns, fields=[pa.field(name, _ARROW[kind]) for name, kind in kinds], mask=pa.array(null))


# -- writing ----------------------------------------------------------------------------------

def _varint_bytes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all varints, their lengths)."""
    v = v.astype(np.uint64)
    parts = (v[:, None] >> (np.uint64(7) * np.arange(VARINT_BYTES, dtype=np.uint64))) & np.uint64(0x7F)
    size = VARINT_BYTES - np.argmax((parts != 0)[:, ::-1], 1)
    size = np.where(v == 0, 1, size)
    place = np.arange(VARINT_BYTES)
    parts |= np.where(place < size[:, None] - 1, np.uint64(0x80), np.uint64(0))
    return parts.astype(np.uint8)[place < size[:, None]], size


def _joined(pieces: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (bytes, length in each row) laid one after the other in every row."""
    total = sum((size for _, size in pieces), np.zeros(n, np.int64))
    at = np.cumsum(total) - total
    out = np.empty(int(total.sum()), np.uint8)
    for data, size in pieces:
        begin = np.cumsum(size) - size
        out[np.repeat(at - begin, size) + np.arange(len(data))] = data
        at = at + size
    return out, total


def _only(data: np.ndarray, size: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data[np.repeat(kept, size)], np.where(kept, size, 0)


def _field(number: int, kind: str, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of a field in every row, its tag included; none for default values."""
    n = len(col)
    tag = np.full(n, number << 3 | _WIRE[kind], np.uint8), np.ones(n, np.int64)
    null = col.is_null().to_numpy(zero_copy_only=False)
    if kind == "text":
        held = col.fill_null("").cast(pa.large_binary())
        _, off, data = held.buffers()
        off = np.frombuffer(off, np.int64)[held.offset:held.offset + n + 1]
        size = np.diff(off)
        body = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
        return _only(*_joined([tag, _varint_bytes(size), (body, size)], n), size > 0)
    if kind == "int":
        v = col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        return _only(*_joined([tag, _varint_bytes(v.view(np.uint64))], n), v != 0)
    if kind == "double":
        v = col.fill_null(0.0).to_numpy(zero_copy_only=False).astype("<f8")
        return _only(*_joined([tag, (v.view(np.uint8), np.full(n, 8))], n), v.view(np.uint64) != 0)
    us = col.cast(pa.timestamp("us", col.type.tz)).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    parts = []
    for number_, part in ((1, us // 1_000_000), (2, us % 1_000_000 * 1000)):
        tag_ = np.full(n, number_ << 3, np.uint8), np.ones(n, np.int64)
        parts.append(_only(*_joined([tag_, _varint_bytes(part.astype(np.int64).view(np.uint64))], n), part != 0))
    body, size = _joined(parts, n)
    return _only(*_joined([tag, _varint_bytes(size), (body, size)], n), ~null)


def encode_batch(rows: pa.StructArray, message: str) -> pa.Array:
    """Structs with the message's fields to message bytes."""
    n = len(rows)
    if not n:
        return pa.array([], pa.binary())
    names = [f.name for f in rows.type]
    data, size = _joined([_field(k, kind, rows.field(names.index(name))) for k, (name, kind) in enumerate(MESSAGES[message], 1)], n)
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(off), pa.py_buffer(data)]).cast(pa.binary())


def from_wire(value: Column, message: str) -> Column:
    """Message bytes as a struct column; null if unreadable."""
    @F.arrow_udf(message_schema(message))
    def read(v: pa.Array) -> pa.Array:
        return decode_batch(v, message)
    return read(value)


def to_wire(row: Column, message: str) -> Column:
    """A struct column with the message's fields as bytes."""
    @F.arrow_udf(T.BinaryType())
    def written(v: pa.Array) -> pa.Array:
        return encode_batch(v, message)
    return written(row)
