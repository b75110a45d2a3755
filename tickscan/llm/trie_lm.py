"""Language-model scores from an n-gram trie in Elias-Fano levels, sharded over the cluster.

The model is a bigram model with Dirichlet smoothing (MacKay and Peto, 1995),

    p(w | u) = (c(u, w) + MU * p(w)) / (c(u) + MU),

over an absolutely discounted unigram model p(w) that keeps the freed mass for unknown words. Its log
splits into a part that needs only w's own entries and a part that needs only c(u), so every token is
looked up once in the shard of its word, and once as a context in that same shard, and documents are
sums over shards.

The trie is stored with the predicted word first, as is usual for reversed tries: level one holds the
words of a shard, with exact counts as a running sum; pointers lead to level two, the contexts of each
word, numbered relative to their word (the word's place, then the context's 32-bit number) so that the
whole level is monotone. All four lists are Elias-Fano coded, the probabilities of level two are
quantised to 16 bits of log. A shard is written as binary columns; a task that scores with it maps it
from an unlinked temporary file and answers all queries by successor search.

Scale: the number of shards follows the number of training tokens (``SHARD_TOKENS``), so the model and
what is gathered for it grow with the corpus and no shard does. A word that makes up more than one in
``HOT`` of all tokens (there are at most ``HOT`` such words) is spread over all shards by its context;
its count is broadcast, as not every shard that is asked for it holds one of its pairs.
Counts are pre-aggregated in map tasks; texts are never shuffled, only hashed tokens.

Defined cases: null or empty text has one token, its end; a null doc_id is scored, never trained on;
every row of the input gives one row, repeated rows too; without training text all scores are those of
the unknown word alone; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, keep, table
from .elias_fano import EliasFano, encode
from .quality_kn import END, bigrams
from .words import chunks, mix

MU = 100.0
SHARD_TOKENS = 2_000_000
BATCH_TOKENS = 1_000_000
HOT = 65536
#: Quantised log10: step and least value.
STEP, LEAST = 1 / 4096, -3.0
INFO = -1  # shard number of rows that describe documents


def _gathered(batches, train: bool):
    """Batches of about BATCH_TOKENS tokens: (rows' columns, row, context, word)."""
    held, n, rows = [], 0, 0
    info: list[pa.RecordBatch] = []

    def out():
        nonlocal held, n, rows, info
        pieces, docs = list(zip(*held)), pa.Table.from_batches(info)
        held, n, rows, info = [], 0, 0, []
        return docs, *(np.concatenate(pieces.pop(0)) for _ in range(3))

    for b in batches:
        for part, words in chunks(b, "text", "space"):
            row, u, w = bigrams(words)
            part = part.drop_columns(["text"])
            if train:
                learn = part.column("learn").to_numpy(zero_copy_only=False).astype(bool)[row]
                row, u, w = row[learn], u[learn], w[learn]
            held.append((row + rows, u, w))
            info.append(part)
            n, rows = n + len(w), rows + len(part)
            if n >= BATCH_TOKENS or rows > 60000:
                yield out()
    if held:
        yield out()


def _unigrams(batches):
    for _, _, _, w in _gathered(batches, True):
        key, n = np.unique(w, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["w", "n"])


def _route(u: np.ndarray, w: np.ndarray, shards: int, hot: np.ndarray) -> np.ndarray:
    """Shard of each token: by its word; for hot words by word and context."""
    shard = (mix(w ^ np.uint64(0x3333333333333333)) % np.uint64(shards)).astype(np.int32)
    if len(hot):
        spread = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, w), len(hot) - 1)] == w)
        shard[spread] = mix(w[spread] * np.uint64(0x9E3779B97F4A7C15) + u[spread]) % np.uint64(shards)
    return shard


def _context(u: np.ndarray) -> np.ndarray:
    return (u >> np.uint64(32)).astype(np.uint32)


def _pieces(shard: np.ndarray):
    edge = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else np.zeros(1, int)
    return zip(edge[:-1], edge[1:])


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of equal values, and run lengths."""
    at = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
    return at, np.diff(np.r_[at, len(x)])


def _train_rows(shards: int, hot):
    def go(batches):
        for _, _, u, w in _gathered(batches, True):
            shard, c = _route(u, w, shards, hot.value[0]), _context(u)
            del u
            order = np.lexsort((c, w, shard))
            shard, c, w = shard[order], c[order], w[order]
            del order
            at = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (w[1:] != w[:-1]) | (shard[1:] != shard[:-1])]) if len(w) else np.zeros(0, int)
            n = np.diff(np.r_[at, len(w)]).astype(np.uint32)
            shard, c, w = shard[at], c[at], w[at]
            rows = []
            for a, z in _pieces(shard):
                first, size = _runs(w[a:z])
                rows.append((int(shard[a]), w[a:z][first].tobytes(), size.astype(np.uint32).tobytes(), c[a:z].tobytes(), n[a:z].tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(("shard", "words", "sizes", "contexts", "counts"), r)) for r in rows],
                                             pa.schema([("shard", pa.int64()), *((x, pa.binary()) for x in ("words", "sizes", "contexts", "counts"))]))
    return go


def _read(cols, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in cols.column(name).to_pylist()]


def quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((np.log10(p) - LEAST) / STEP), 0, 65535).astype(np.uint16)


def _build(hot, model: dict):
    """One shard's trie from all pieces of it."""
    def go(t: pa.Table) -> pa.Table:
        w = np.concatenate([np.repeat(a, s) for a, s in zip(_read(t, "words", np.uint64), _read(t, "sizes", np.uint32))])
        c, n = (np.concatenate(_read(t, x, np.uint32)) for x in ("contexts", "counts"))
        order = np.lexsort((c, w))
        w, c, n = w[order], c[order], n[order].astype(np.int64)
        at = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (c[1:] != c[:-1])])
        n, w, c = np.add.reduceat(n, at), w[at], c[at]
        first, size = _runs(w)
        words, total = w[first], np.add.reduceat(n, first)
        names, counts = hot.value
        if len(names):
            i = np.minimum(np.searchsorted(names, words), len(names) - 1)
            total = np.where(names[i] == words, counts[i], total)
        p = (total - model["discount"]) / model["tokens"]
        value = quantise(n + MU * np.repeat(p, size))
        place = np.repeat(np.arange(len(words), dtype=np.uint64), size)
        out = {"shard": int(t.column("shard")[0].as_py()), "words": encode(words),
               "counts": encode(np.cumsum(total)), "pointers": encode(np.cumsum(size)),
               "contexts": encode((place << np.uint64(32)) | c), "values": value.tobytes()}
        return pa.Table.from_pylist([out], pa.schema([("shard", pa.int64()), *((x, pa.binary()) for x in LEVELS)]))
    return go


LEVELS = ("words", "counts", "pointers", "contexts", "values")
MODEL_SCHEMA = "shard long, words binary, counts binary, pointers binary, contexts binary, values binary"


class Trie:
    """A shard's levels, read from a memory-mapped temporary file that is gone with the object."""

    def __init__(self, levels: dict[str, bytes], model: dict):
        self.model = model
        with tempfile.TemporaryFile() as f:
            at = {}
            for name in LEVELS:
                f.write(b"\0" * (-f.tell() % 8))
                at[name] = (f.tell(), len(levels[name]))
                f.write(levels[name])
            f.flush()
            data = np.memmap(f, np.uint8, "r")
        part = {k: data[a:a + n] for k, (a, n) in at.items()}
        self.words, self.counts, self.pointers, self.contexts = (EliasFano(part[x]) for x in LEVELS[:4])
        self.values = part["values"].view(np.uint16)

    def count(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place or -1, training count) of each word."""
        place, n = self.words.find(words), np.zeros(len(words), np.int64)
        held = np.flatnonzero(place >= 0)
        at = place[held]
        upto = self.counts.select(at).astype(np.int64)
        before = np.where(at > 0, self.counts.select(np.maximum(at - 1, 0)).astype(np.int64), 0)
        n[held] = upto - before
        return place, n

    def unigram(self, n: np.ndarray) -> np.ndarray:
        m = self.model
        return np.where(n > 0, (n - m["discount"]) / m["tokens"], m["unknown"])

    def log_joint(self, place: np.ndarray, n: np.ndarray, size: np.ndarray, context: np.ndarray) -> np.ndarray:
        """log10(c(u, w) + MU * p(w)) of each pair: words by place and count, and for each the ``size``
        contexts that follow one another in ``context``, sorted."""
        out = np.repeat(np.log10(MU * self.unigram(n)), size)
        of = np.repeat(place, size)
        known = np.flatnonzero(of >= 0)
        x = (of[known].astype(np.uint64) << np.uint64(32)) | context[known]
        first, times = _runs(x)
        at = np.repeat(self.contexts.find(x[first]), times)
        inside = np.flatnonzero(at >= 0)
        out[known[inside]] = self.values[at[inside]] * STEP + LEAST
        return out


EMPTY = {x: encode(np.zeros(0, np.uint64)) for x in LEVELS[:4]} | {"values": b""}


def _query_rows(shards: int, hot):
    def go(batches):
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 24
        for k, (info, row, u, w) in enumerate(_gathered(batches, False)):
            shard, c, row = _route(u, w, shards, hot.value[0]), _context(u), row.astype(np.uint16)
            del u
            order = np.lexsort((c, w, shard))
            shard, c, w, row = shard[order], c[order], w[order], row[order]
            del order
            n = np.bincount(row, minlength=len(info)).astype(np.int64)
            rows = [{"shard": INFO - (base + k) % 1009, "batch": base + k, "n_rows": len(info), "words": n.tobytes(), "sizes": b"",
                     "contexts": b"", "docs": b"", "ids": info.column("id").to_pylist(), "held": info.column("held_out").to_pylist()}]
            for a, z in _pieces(shard):
                first, size = _runs(w[a:z])
                rows.append({"shard": int(shard[a]), "batch": base + k, "n_rows": len(info), "words": w[a:z][first].tobytes(),
                             "sizes": size.astype(np.uint32).tobytes(), "contexts": c[a:z].tobytes(), "docs": row[a:z].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, QUERY_ARROW)
    return go


QUERY_SCHEMA = "shard long, batch long, n_rows int, words binary, sizes binary, contexts binary, docs binary, ids array<long>, held array<boolean>"
QUERY_ARROW = pa.schema([("shard", pa.int64()), ("batch", pa.int64()), ("n_rows", pa.int32()),
                         *((x, pa.binary()) for x in ("words", "sizes", "contexts", "docs")),
                         ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])
SUM_SCHEMA = "batch long, n_rows int, known binary, base binary, score binary, n binary, ids array<long>, held array<boolean>"
SUM_ARROW = pa.schema([("batch", pa.int64()), ("n_rows", pa.int32()), *((x, pa.binary()) for x in ("known", "base", "score", "n")),
                       ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])


def _answer(model: dict, hot):
    """Partial sums of each batch's documents over the tokens of one shard."""
    def go(left: pa.Table, right: pa.Table) -> pa.Table:
        trie, rows = None, []
        for q in left.to_pylist() if len(left) else ():
            if q["shard"] <= INFO:
                rows.append({"batch": q["batch"], "n_rows": q["n_rows"], "n": q["words"], "ids": q["ids"], "held": q["held"]})
                continue
            if trie is None:
                trie = Trie(right.to_pylist()[0] if len(right) else EMPTY, model)
            size, doc = np.frombuffer(q["sizes"], np.uint32), np.frombuffer(q["docs"], np.uint16)
            words = np.frombuffer(q["words"], np.uint64)
            place, n = trie.count(words)
            names, counts = hot.value
            if len(names):
                i = np.minimum(np.searchsorted(names, words), len(names) - 1)
                n = np.where(names[i] == words, counts[i], n)
            score = trie.log_joint(place, n, size, np.frombuffer(q["contexts"], np.uint32)) - np.repeat(np.log10(n + MU), size)
            sums = [np.bincount(doc, x, q["n_rows"]) for x in (np.repeat(np.log10(n + 0.1), size), score)]
            rows.append({"batch": q["batch"], "n_rows": q["n_rows"], "known": np.bincount(doc, np.repeat(n > 0, size), q["n_rows"]).astype(np.int32).tobytes(),
                         "base": sums[0].tobytes(), "score": sums[1].astype(np.float32).tobytes()})
        return pa.Table.from_pylist(rows, SUM_ARROW)
    return go


def _finish(model: dict):
    def go(t: pa.Table) -> pa.Table:
        n_rows = t.column("n_rows")[0].as_py()
        known, base, score = np.zeros(n_rows, np.int64), np.zeros(n_rows), np.zeros(n_rows)
        info = None
        for r in t.to_pylist():
            if r["n"] is not None:
                info = r
                continue
            known += np.frombuffer(r["known"], np.int32)
            base += np.frombuffer(r["base"], np.float64)
            score += np.frombuffer(r["score"], np.float32)
        n = np.frombuffer(info["n"], np.int64)
        base = base - n * np.log10(model["tokens"] + 0.1 * (model["types"] + 1))
        return pa.Table.from_arrays([pa.array(info["ids"], pa.int64()), pa.array(info["held"], pa.bool_()), pa.array(n), pa.array(known),
                                     pa.array(np.full(n_rows, model["train_tokens"])), pa.array(base), pa.array(score)],
                                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return go


def train(texts: DataFrame, shard_tokens: int = SHARD_TOKENS, hot_least: int = 1000):
    """The model table of ``texts`` (learn, text), its numbers, and the broadcast hot words, those of
    more than ``hot_least`` and more than one in ``HOT`` tokens."""
    spark = texts.sparkSession
    texts = texts.select("learn", "text")
    uni = keep(texts.mapInArrow(_unigrams, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "trie-unigrams")
    types, tokens, once, twice = uni.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") == 1, 1)),
                                         F.count(F.when(F.col("n") == 2, 1))).first()
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
    model = {"tokens": max(1, tokens), "train_tokens": tokens, "types": types, "discount": discount,
             "unknown": discount * types / tokens if tokens else 1.0}
    # fewer than HOT words can have more than tokens / HOT of all tokens
    often = uni.where(F.col("n") > max(hot_least, tokens // HOT)).toArrow()
    names, counts = often.column("w").to_numpy().view(np.uint64), often.column("n").to_numpy()
    order = np.argsort(names)
    hot = spark.sparkContext.broadcast((names[order], counts[order]))
    model["shards"] = max(1, -(-tokens // shard_tokens))
    pieces = texts.mapInArrow(_train_rows(model["shards"], hot), "shard long, words binary, sizes binary, contexts binary, counts binary")
    built = keep(pieces.groupBy("shard").applyInArrow(_build(hot, model), MODEL_SCHEMA), "trie-model")
    drop(uni)
    return built, model, hot


def score(texts: DataFrame, trie: DataFrame, model: dict, hot) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for ``texts`` (id, held_out, text)."""
    asked = texts.select("id", "held_out", "text").mapInArrow(_query_rows(model["shards"], hot), QUERY_SCHEMA)
    sums = asked.groupBy("shard").cogroup(trie.groupBy("shard")).applyInArrow(_answer(model, hot), SUM_SCHEMA)
    shape = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return sums.groupBy("batch").applyInArrow(_finish(model), shape)


def trie_lm(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows where ``learn`` holds and score all rows of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"),
                       F.coalesce(~learn, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    trie, model, hot = train(rows)
    out = keep(score(rows, trie, model, hot), "trie-scores")
    drop(trie)
    return out.withColumnRenamed("id", id_col)


def op4_trie_lm(spark, sf_dir):
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    return trie_lm(table(spark, sf_dir, "documents"), learn)
