"""Periodic runs of words, and texts with each run cut to its first period.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at
least ``max(MIN_LENGTH, MIN_EXPONENT * q)`` words long, that no neighbouring word extends.

Method: the dictionary of basic factors. Every factor of 1, 2, 4, ... words gets a name, two of
them making one of the next length; occurrences of a name are only looked for inside its own text.
If an occurrence's successor follows within twice the length, at distance d, and so do those of the
next positions, these progressions propose d as a period of the stretch they cover. A period q is
read from the one length with ``length / 2 < q <= length``: inside a run the successor of a factor
at least q long is exactly q further on. The stretch is extended while words q apart agree, and
equal proposals are merged. A name that occurs once in its text is dropped, and with it every
longer factor over that place, so plain text costs a few levels only.

Texts are taken whole, one row at a time being the least that a task holds (its words as integers);
nothing is shuffled. Words are told apart exactly, by their bytes.

Defined cases: null and empty texts, and texts of white space, have no words, no run and the empty
collapsed text; rows that repeat an id or a text, or have a null id, are judged each for itself;
two runs of equal exponent: the smaller start, then the smaller period, is the strongest; empty
tables give no rows; extra columns are kept by ``runs`` and its own get underscores where names clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, table
from .words import CHUNK_BYTES, SEPARATORS, column_bytes

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Between words, for Spark's expressions.
GAP = r"[\x20\x09-\x0D]+"


def split_words(buf: np.ndarray, offsets: np.ndarray, also: np.ndarray | None = None) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(first, words, data, cut) of the texts in ``buf``: the n + 1 word offsets by row, the words by
    their distinct bytes, and their bytes with their offsets. A word is cut again where ``also`` says so."""
    sep = SEPARATORS["space"][buf]
    starts = np.empty(len(buf), bool)
    starts[:1] = True
    starts[1:] = sep[:-1]
    edge = offsets[:-1]
    starts[edge[edge < len(buf)]] = True
    if also is not None:
        starts |= also
    word = ~sep
    at = np.flatnonzero(starts & word)
    data = buf[word]
    before = np.cumsum(word) - word
    cut = np.append(before[at], len(data)).astype(np.int64)
    held = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(cut), pa.py_buffer(data)])
    return np.searchsorted(at, offsets), held.dictionary_encode(), data, cut


def word_ids(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``split_words`` with a number for each word, equal for equal bytes."""
    first, words, data, cut = split_words(buf, offsets)
    return first, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), data, cut


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): a stable order by key, and where a new key begins in it."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.empty(len(k), bool)
    new[:1] = True
    np.not_equal(k[1:], k[:-1], out=new[1:])
    return order, new


def find_runs(row: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Rows (row, start, length, period) of the runs, sorted by row, start and period; ``start``
    counts over all texts. ``row`` is the text of each word (ascending), ``ids`` its word."""
    n = len(ids)
    if n == 0:
        return np.zeros((0, 4), np.int64)
    longest = int(np.bincount(row).max())
    pos = np.arange(n, dtype=np.int64)  # where the factors still alive start
    keys = row * (int(ids.max()) + 1) + ids
    found = []
    size = 1
    while len(pos) and MIN_EXPONENT * (size // 2 + 1) <= longest:
        order, new = _named(keys)
        name = np.empty(len(pos), np.int64)
        name[order] = np.cumsum(new) - 1
        p = pos[order]
        step = np.zeros(len(pos), np.int64)  # to the successor; 0: none
        follows = np.flatnonzero(~new)
        step[order[follows - 1]] = p[follows] - p[follows - 1]
        near = (step > size // 2) & (step <= size)
        if near.any():
            at, d = pos[near], step[near]
            split = np.flatnonzero((np.diff(at) != 1) | (np.diff(d) != 0)) + 1
            a = at[np.concatenate([[0], split])]
            b = at[np.concatenate([split - 1, [len(at) - 1]])]
            found.append(np.stack([a, b + size + d[np.concatenate([[0], split])], d[np.concatenate([[0], split])]], 1))
        # longer factors: only over names that occur twice
        twice = np.empty(len(new), bool)
        alone = new & np.append(new[1:], True)
        twice[order] = ~alone
        pos, name = pos[twice], name[twice]
        at = np.searchsorted(pos, pos + size)
        ok = at < len(pos)
        ok[ok] = pos[at[ok]] == pos[ok] + size
        ok[ok] &= row[pos[ok]] == row[pos[ok] + size]
        left, right = name[ok], name[at[ok]]
        pos = pos[ok]
        keys = left * (int(right.max()) + 1 if len(right) else 1) + right
        size *= 2
    if not found:
        return np.zeros((0, 4), np.int64)
    spans = np.concatenate(found)
    # a run of exponent 4 is proposed over its whole stretch or not at all; shorter ones go first
    spans = spans[spans[:, 1] - spans[:, 0] >= np.maximum(MIN_LENGTH, MIN_EXPONENT * spans[:, 2])]
    return _extended(row, ids, spans)


def _extended(row: np.ndarray, ids: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Proposed (start, end, period) grown while words a period apart agree, each run once."""
    n = len(ids)
    out = set()
    for s, e, q in spans.tolist():
        while s > 0 and row[s - 1] == row[s] and ids[s - 1] == ids[s - 1 + q]:
            s -= 1
        while e < n and row[e] == row[s] and ids[e] == ids[e - q]:
            e += 1
        out.add((int(row[s]), s, e - s, q))
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The (start, length, period) of greatest exact length / period."""
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q or (n * best[2] == best[1] * q and (s, q) < (best[0], best[2])):
            best = (s, n, q)
    return best


def _collapsed(first: np.ndarray, found: np.ndarray, data: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets by row): the words outside the repeats of any run, joined by one space."""
    n = len(cut) - 1
    drops = np.zeros(n + 1, np.int64)
    np.add.at(drops, found[:, 1] + found[:, 3], 1)
    np.add.at(drops, found[:, 1] + found[:, 2], -1)
    kept = np.cumsum(drops[:n]) == 0
    size = np.diff(cut) + 1
    to = np.cumsum(size)
    out = np.full(int(to[-1]) if n else 0, 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[to - 1] = False
    out[inside] = data
    out = out[np.repeat(kept, size)]
    ends = np.concatenate([[0], np.cumsum(np.where(kept, size, 0))])[first]
    return out, ends


def _rows(arr: pa.Array) -> Iterator[tuple[list, bytes]]:
    """By text, its runs as (start, length, period), and its collapsed bytes."""
    buf, off = column_bytes(arr)
    at, rows = 0, len(arr)
    while at < rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + CHUNK_BYTES, "right")) - 1)
        first, ids, data, cut = word_ids(buf[off[at]:off[to]], off[at:to + 1] - off[at])
        found = find_runs(np.repeat(np.arange(to - at), np.diff(first)), ids)
        joined, ends = _collapsed(first, found, data, cut)
        of = np.searchsorted(found[:, 0], np.arange(to - at + 1))
        for i in range(to - at):
            mine = found[of[i]:of[i + 1]]
            spans = [(int(s - first[i]), int(n), int(q)) for _, s, n, q in mine]
            yield spans, joined[ends[i]:max(ends[i], ends[i + 1] - 1)].tobytes()
        at = to


def runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with runs (array of start, length, period, by start then period) and collapsed."""
    names = [free_name(docs, c) for c in ("runs", "collapsed")]
    span = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], span), T.StructField(names[1], T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            done = list(_rows(batch.column(text)))
            spans = pa.array([[dict(zip(("start", "length", "period"), s)) for s in d[0]] for d in done], kind)
            texts = pa.array([d[1] for d in done], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, spans, texts], [*batch.schema.names, *names])

    return docs.mapInArrow(work, schema)


def with_planted(text: Column, key: Column) -> Column:
    """The text op11 reads: with h = crc32(key), where ``h % 10 = 0`` the words from ``a`` on repeat
    the first ``p`` of them (a = g % n, p = 1 + (n - a) // (3 + g % 8), g = h // 10)."""
    h = F.crc32(key.cast("string").cast("binary"))
    w = F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")
    g = F.floor(h / 10)

    def turned(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
            F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

    # one element: the words are made once and bound to a name
    made = F.element_at(F.transform(F.array(w), lambda v: F.when(F.size(v) > 0, turned(v)).otherwise(F.lit(""))), 1)
    return F.when(h % 10 == 0, made).otherwise(text)


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each text: the id, n_runs, the strongest run and the two digests."""
    fields = [("n_runs", T.LongType()), ("start", T.LongType()), ("length", T.LongType()), ("period", T.LongType()),
              ("exponent_milli", T.LongType()), ("runs_sha256", T.StringType()), ("collapsed_sha256", T.StringType())]
    schema = T.StructType([docs.schema[id_col], *[T.StructField(c, t) for c, t in fields]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        for batch in batches:
            out = [[] for _ in kinds]
            for spans, joined in _rows(batch.column(text)):
                best = strongest(spans)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in spans)
                row = [len(spans), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                       hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(joined).hexdigest()]
                for col, v in zip(out, row):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *[pa.array(c, k) for c, k in zip(out, kinds)]],
                                             [id_col, *[c for c, _ in fields]])

    return docs.select(id_col, text).mapInArrow(work, schema)


def op11_runs(spark, sf_dir):
    """One row per document: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256."""
    docs = table(spark, sf_dir, "documents")
    return digests(docs.select("doc_id", with_planted(F.col("text"), F.col("doc_id")).alias("text")))
