"""Elias-Fano lists of monotone integers, read where they lie.

A list of n values up to u is stored as low parts of whole bytes and a bitmap of high parts in unary,
about 2 bits and log2(u / n) rounded up to bytes for each value. ``select`` reads values by place and
``successor`` finds the first place whose value is at least x; both take arrays and touch only the
words they need, so a list can be a view of a memory-mapped file.
"""

from __future__ import annotations

import numpy as np

_HEAD = 4  # n, bytes of a low part, words of the bitmap, largest high part
#: Place of the k-th (from 0) one of each byte; 0 if it has fewer.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64)


def encode(values: np.ndarray) -> bytes:
    """The list of sorted unsigned 64-bit ``values``, in one piece."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    top = int(v[-1]) if n else 0
    low = min(8, -(-max(0, (top // max(1, n)).bit_length() - 1) // 8))
    high = (v >> np.uint64(8 * low)).astype(np.int64) if low < 8 else np.zeros(n, np.int64)
    words = (n + (int(high[-1]) if n else 0) + 1 + 63) // 64
    bits = np.zeros(words * 64, np.uint8)
    bits[high + np.arange(n)] = 1
    lows = v.view(np.uint8).reshape(n, 8)[:, :low] if n else np.zeros((0, low), np.uint8)
    head = np.array([n, low, words, int(high[-1]) if n else 0], np.int64)
    return head.tobytes() + np.packbits(bits, bitorder="little").tobytes() + np.ascontiguousarray(lows).tobytes()


class EliasFano:
    def __init__(self, data: np.ndarray):
        """``data``: the bytes that ``encode`` made, as uint8 (a memory map or any array)."""
        self.n, self.low, words, self.top = (int(x) for x in np.asarray(data[:8 * _HEAD]).view(np.int64))
        at = 8 * _HEAD
        self.bits = data[at:at + 8 * words]
        self.lows = data[at + 8 * words:at + 8 * words + self.n * self.low]
        # directory: ones before each 64-bit word
        ones = np.bitwise_count(np.asarray(self.bits).view(np.uint64)).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = 64 * np.arange(len(self.ones)) - self.ones

    def _pick(self, before: np.ndarray, rank: np.ndarray, bit: int) -> np.ndarray:
        """Place in the bitmap of the rank-th (from 0) one or zero."""
        word = np.searchsorted(before, rank, "right") - 1
        out = np.empty(len(rank), np.int64)
        bits = np.asarray(self.bits).view(np.uint64)
        for a in range(0, len(rank), 65536):
            w = word[a:a + 65536]
            x = bits[w] if bit else ~bits[w]
            left, at = rank[a:a + 65536] - before[w], np.zeros(len(w), np.int64)
            for half in (32, 16, 8):  # the half of the word that holds it, down to a byte
                n = np.bitwise_count(x & np.uint64((1 << half) - 1)).astype(np.int64)
                up = left >= n
                left -= np.where(up, n, 0)
                at += np.where(up, half, 0)
                x = np.where(up, x >> np.uint64(half), x)
            out[a:a + 65536] = 64 * w + at + _IN_BYTE[(x & np.uint64(0xFF)).astype(np.int64), left]
        return out

    def _low(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        if self.low:
            out[:, :self.low] = np.asarray(self.lows).reshape(-1, self.low)[at]
        return out.view(np.uint64)[:, 0]

    def select(self, at: np.ndarray) -> np.ndarray:
        """Values at places ``at``."""
        at = np.asarray(at, np.int64)
        if not len(at):
            return np.zeros(0, np.uint64)
        high = (self._pick(self.ones, at, 1) - at).astype(np.uint64)
        return (high << np.uint64(8 * self.low) if self.low < 8 else np.zeros(len(at), np.uint64)) | self._low(at)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """First place whose value is at least x; n if there is none."""
        return self._search(x)[0]

    def find(self, x: np.ndarray) -> np.ndarray:
        """First place whose value is x; -1 if there is none."""
        at, last, want = self._search(x)
        here = np.flatnonzero(at < last)  # values of the same high part
        here = here[self._low(at[here]) == want[here]]
        out = np.full(len(at), -1, np.int64)
        out[here] = at[here]
        return out

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first place whose value is at least x, end of the values with x's high part, x's low part)."""
        x = np.asarray(x, np.uint64)
        if not len(x) or not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), x
        high = x >> np.uint64(8 * self.low) if self.low < 8 else np.zeros(len(x), np.uint64)
        beyond = high > np.uint64(self.top)
        h = np.minimum(high, np.uint64(self.top)).astype(np.int64)
        first = np.where(h > 0, self._pick(self.zeros, np.maximum(h - 1, 0), 0) - h + 1, 0)
        last = np.where(h < self.top, self._pick(self.zeros, np.minimum(h, max(self.top - 1, 0)), 0) - h, self.n)
        low_mask = (np.uint64(1) << np.uint64(8 * self.low)) - np.uint64(1) if self.low < 8 else np.uint64(0xFFFFFFFFFFFFFFFF)
        want = x & low_mask
        lo, hi = first, last.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            less = self._low(mid) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        return np.where(beyond, self.n, lo), np.where(beyond, 0, last), want
