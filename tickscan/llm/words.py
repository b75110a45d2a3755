"""Whole-batch tokenising and hashing of UTF-8 text with numpy, for use inside Arrow tasks.

A batch of texts is one byte buffer. Words are found by comparing each byte with a separator
table, and every word gets a 64-bit polynomial hash taken from prefix sums over the buffer, so no
Python string is made per word. Only A-Z is lower-cased (through the byte table); bytes of
non-ASCII characters are word bytes and keep their case, as the contracts ask.

Null and empty texts have no words. Texts of any length are handled whole: a batch is cut into
chunks of rows, never inside a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer single text makes a chunk of its own.
CHUNK_BYTES = 2 << 20

_M = (1 << 64) - 1
_ODD = 0x9E3779B97F4A7C15
_INV = pow(_ODD, -1, 1 << 64)


def _separators(kind: str) -> np.ndarray:
    b = np.arange(256)
    if kind == "space":  # words [^\x20\x09-\x0D]+
        return (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
    if kind == "alnum":  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
        keep = (b >= 0x80) | ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x61) & (b <= 0x7A)) | ((b >= 0x41) & (b <= 0x5A))
        return ~keep
    raise ValueError(f"unknown kind of words: {kind}")


SEPARATORS = {k: _separators(k) for k in ("space", "alnum")}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _byte_values() -> np.ndarray:
    low = np.arange(256)
    low[0x41:0x5B] += 0x20
    return mix((low.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD))


_BYTES = _byte_values()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        take = min(done, n - done)
        out[done:done + take] = out[:take] * np.uint64(pow(base, done, 1 << 64))
        done += take
    return out


_tables: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _tables or len(_tables["p"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _tables["p"], _tables["i"] = _powers(_ODD, size), _powers(_INV, size)
    return _tables["p"], _tables["i"]


def column_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The byte buffer and the n + 1 offsets of a string column; a null has no bytes."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not (pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type)):
        arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    _, off, data = arr.buffers()
    if off is None or len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[o[0]:o[-1]], o - o[0]


@dataclass
class Words:
    """Words of some rows: ``first`` (n + 1 word offsets by row), and by word its hash and bytes."""

    first: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    prefix: np.ndarray
    buf: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def piece_hash(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the ``size`` bytes that start at byte positions ``at``."""
        _, inv = _power_tables(len(self.buf) + 1)
        return mix((self.prefix[at + size] - self.prefix[at]) * inv[at])


def words_of(buf: np.ndarray, offsets: np.ndarray, kind: str) -> Words:
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64), z, z, np.zeros(1, np.uint64), buf)
    sep = SEPARATORS[kind][buf]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, sep[:-1]
    after[-1], after[:-1] = True, sep[1:]
    cut = offsets[1:-1]
    before[cut[cut < n]] = True
    after[cut[cut > 0] - 1] = True
    word = ~sep
    start = np.flatnonzero(word & before)
    end = np.flatnonzero(word & after) + 1
    pw, inv = _power_tables(n + 1)
    prefix = np.empty(n + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(_BYTES[buf] * pw[:n], out=prefix[1:])
    h = mix((prefix[end] - prefix[start]) * inv[start])
    return Words(np.searchsorted(start, offsets), h, start, end, prefix, buf)


def chunks(batch: pa.RecordBatch, text: str = "text", kind: str = "space") -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Slices of a batch with the words of their texts, each of about ``CHUNK_BYTES`` of text."""
    buf, off = column_bytes(batch.column(text))
    row, rows = 0, len(batch)
    while row < rows:
        to = max(row + 1, int(np.searchsorted(off, off[row] + CHUNK_BYTES, "right")) - 1)
        yield batch.slice(row, to - row), words_of(buf[off[row]:off[to]], off[row:to + 1] - off[row], kind)
        row = to


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive word hashes (positions across rows too)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(k):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25) + h[j:j + m]
    return mix(out)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets by row, hashes): every run of k words inside a row; a row of fewer words gives its
    whole sequence as one, a row without words none."""
    n = w.counts()
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    off = np.zeros(len(n) + 1, np.int64)
    np.cumsum(size, out=off[1:])
    out = np.empty(off[-1], np.uint64)
    whole = rolling(w.hash, k)
    for short in range(1, k):
        rows = np.flatnonzero(n == short)
        if len(rows):
            out[off[rows]] = rolling(w.hash, short)[w.first[rows]]
    rows = np.flatnonzero(n >= k)
    if len(rows):
        reps = size[rows]
        at = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        out[np.repeat(off[rows], reps) + at] = whole[np.repeat(w.first[rows], reps) + at]
    return off, out


def sets_by_row(off: np.ndarray, h: np.ndarray) -> Iterator[np.ndarray]:
    """By row, the distinct hashes as sorted signed integers."""
    h = h.view(np.int64)
    for i in range(len(off) - 1):
        s = np.sort(h[off[i]:off[i + 1]])
        if len(s) > 1:
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            s = s[keep]
        yield s


def lists(values: list[np.ndarray], kind=np.int64) -> pa.Array:
    """A list column from one array for each row."""
    off = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=off[1:])
    flat = np.concatenate(values) if values else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat.astype(kind, copy=False)))
