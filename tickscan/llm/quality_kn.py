"""Quality classifier: perplexity under an interpolated modified Kneser-Ney bigram model.

The model is trained on trusted text: documents that labels call good, one half of them by a hash of
the id. Counts, continuation counts and the three discounts are distributed aggregates. The log
probability of a document splits into a sum over its words and one over its pairs of words,

    log p(w | u) = log p_cont(w) + log backoff(u) + (seen: gain(u, w)),
    gain(u, w) = log(1 + (n(u, w) - discount) / (freed(u) * p_cont(w))),

and every word of a text is a context once and a successor once. So both are looked up by one key: the model
is a table of (key, value), cut by ranges of the key into shards of about ``SHARD`` rows. Texts are tokenised
once; their distinct words and pairs, with counts, go to the shards of their keys and meet them there (a
join of counts, sharded on both sides); what comes back is one partial sum for each document and
shard. The ``HOT`` commonest words of the model are looked up before and not sent.

Work goes in ``SLICES``: pairs by key while the model is made, documents by a hash while they are
scored, so that only a part of the shuffled rows is on disk at a time. The number of shards follows the model; a
task holds one shard and the keys of one slice that ask for it. Trusted texts are joined with their labels
once and written, in ``DEALS``. What is sent between documents and shards are columns of whole numbers,
one row for each block of documents gathered and shard: sorted keys as differences, the documents as places in
their block, the sums as steps of ``STEP``; so with many shards, when a document has a sum in nearly every
shard that it asks, the sums stay smaller than the keys asked.

The threshold of a language is a quantile of the perplexity of its other half of trusted documents,
which the model has not seen (``percentile_approx`` at an accuracy of 1/10,000 in rank); a language
without any takes that of all trusted documents. A document whose perplexity equals the threshold is kept.

Defined cases: null or empty text has one token, its end; null language is a language of its own;
rows that repeat an id are judged each on their own text, and equal rows alike; rows with null id are
scored, never trained on; without trusted text every document is kept and its perplexity is that of a
uniform choice; empty tables and extra columns are harmless.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import drop, keep, prepare, table
from .words import Words, chunks, mix

SHARD = 1_000_000
SLICES = 8
DEALS = 2
#: Words looked up from a broadcast of their values.
HOT = 65_536
#: Tokens gathered in a task before they are sent, at least; with many shards so many for each.
GATHER, GATHER_SHARD = 1_000_000, 64
#: Model values are whole numbers of this step (of log10).
STEP = 2.0 ** -27
QUANTILE = 0.98
END = np.uint64(0x5E9D5E9D5E9D5E9D)


def bigrams(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, context, word) of every token: the words of a row and its end; the first context is the end."""
    n = w.counts() + 1
    off = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=off[1:])
    word = np.full(off[-1], END, np.uint64)
    row = np.repeat(np.arange(len(n)), n)
    word[np.arange(len(w.hash)) + w.row()] = w.hash
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[off[:-1]] = END
    return row, context, word


def pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0x9E3779B97F4A7C15) + word)


def _counts(part: int, of: int):
    """Counts of the pairs of one slice, added up over about ``GATHER`` tokens of a task before they are
    shuffled."""
    def go(batches):
        held, tokens = [], 0

        def out():
            u, x = (np.concatenate(v) for v in zip(*held))
            _, at, n = np.unique(pair(u, x), return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in (u[at], x[at])] + [pa.array(n)], ["u", "w", "n"])

        for b in batches:
            for _, w in chunks(b, "text", "space"):
                _, u, x = bigrams(w)
                mine = _of_shard(pair(u, x), of) == part
                held.append((u[mine], x[mine]))
                tokens += int(mine.sum())
                if tokens >= GATHER:
                    yield out()
                    held, tokens = [], 0
        if held:
            yield out()
    return go


def _discounts(counts: DataFrame, col: str) -> tuple[float, float, float]:
    n1, n2, n3, n4 = counts.agg(*[F.sum((F.col(col) == i).cast("long")) for i in (1, 2, 3, 4)]).first()
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * (n3 or 0) / n2, 3 - 4 * y * (n4 or 0) / n3 if n3 else 1.5]
    return tuple(min(max(v, 0.1), i + 0.9) for i, v in enumerate(d))


def _less(col: str, d: tuple[float, float, float]):
    return F.when(F.col(col) == 1, d[0]).when(F.col(col) == 2, d[1]).otherwise(d[2])


def counted(texts: DataFrame) -> list[DataFrame]:
    """Counts of the pairs of all texts, in written slices; ``texts`` is read once for each."""
    return [keep(texts.mapInArrow(_counts(k, SLICES), "u long, w long, n long").groupBy("u", "w").agg(F.sum("n").alias("n")), "kn-bigrams")
            for k in range(SLICES)]


def train(texts: DataFrame) -> tuple[DataFrame, float]:
    """The model as rows (key, value, seen), and log10 p_cont of an unknown word. A word's value is what it
    adds to a document above an unknown one, ``seen`` its count; a pair's is its gain."""
    return fitted(counted(texts))


def fitted(slices: list[DataFrame]) -> tuple[DataFrame, float]:
    """The model of counted pairs, which are deleted."""
    bi = reduce(DataFrame.union, slices)
    low = keep(bi.groupBy("w").agg(F.count("*").alias("before")), "kn-words")
    vocabulary, pairs = low.agg(F.count("*"), F.coalesce(F.sum("before"), F.lit(0))).first()
    if not vocabulary:
        drop(low, *slices)
        return keep(bi.sparkSession.createDataFrame([], MODEL), "kn-model"), -1.0
    d1, d2 = _discounts(low, "before"), _discounts(bi, "n")
    freed = low.agg(F.sum(F.least("before", _less("before", d1)))).first()[0] / pairs
    unknown = freed / (vocabulary + 1)
    p_cont = low.select("w", ((F.col("before") - F.least("before", _less("before", d1))) / pairs + unknown).alias("p"))
    ctx = bi.groupBy("u").agg(F.sum("n").alias("seen"), F.sum(_less("n", d2)).alias("freed"))
    # each token follows one and is followed by one, so every word is in both
    words = keep(p_cont.join(ctx, F.col("w") == F.col("u")).select("w", "p", "seen", "freed"), "kn-words")
    value = F.log10("p") + F.log10(F.col("freed") / F.col("seen")) - F.lit(float(np.log10(unknown)))
    parts = [keep(words.select(F.col("w").alias("u"), F.lit(None).cast("long").alias("w"), value.alias("value"), "seen")
                  .mapInArrow(_model_keys, MODEL), "kn-model")]
    left = words.select(F.col("w").alias("u"), "freed")
    right = words.select("w", "p")
    for part in slices:
        gain = F.log10(1 + F.greatest(F.col("n") - _less("n", d2), F.lit(0.0)) / (F.col("freed") * F.col("p")))
        rows = part.join(left, "u").join(right, "w").select("u", "w", gain.alias("value"), F.lit(None).cast("long").alias("seen"))
        parts.append(keep(rows.mapInArrow(_model_keys, MODEL), "kn-model"))
        drop(part)
    drop(low, words)
    model = reduce(DataFrame.union, parts)
    model._parts = parts
    return model, float(np.log10(unknown))


MODEL = "key long, value int, seen long"


def word_key(w):
    return mix(w ^ np.uint64(0x1111111111111111))


def _model_keys(batches):
    for b in batches:
        u = b.column("u").to_numpy().view(np.uint64)
        pairs = b.column("w").is_valid().to_numpy(zero_copy_only=False)
        w = b.column("w").fill_null(0).to_numpy().view(np.uint64)
        key = np.where(pairs, pair(u, w), word_key(u))
        value = np.rint(b.column("value").to_numpy() / STEP).clip(-2.0 ** 31, 2.0 ** 31 - 1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(value), b.column("seen")], ["key", "value", "seen"])


def _look(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of each asked key in steps, 0 if the table (sorted by key) has none."""
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0).astype(np.int64)


def _of_shard(key: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the keys; ``Shards`` has the same for columns."""
    return (((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _squeezed(a: np.ndarray) -> bytes:
    """Whole numbers as bytes, the first byte of all, the second of all and so on: small numbers take little."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T)
    return len(a).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _restored(data: bytes, kind) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _squeezed_keys(keys: np.ndarray) -> bytes:
    return _squeezed(np.diff(keys, prepend=np.uint64(0)))


def _restored_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_restored(data, np.uint64), dtype=np.uint64)


def _entries(row: np.ndarray, key: np.ndarray):
    """(row, key, count) of the distinct words and pairs of each row, sorted by key."""
    order = np.argsort(key, kind="stable")  # the rows of equal keys ascend already
    row, key = row[order], key[order]
    at = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])])
    return row[at], key[at], np.diff(np.r_[at, len(key)]).astype(np.uint32)


def _asked(shards: int, hot, unknown: float, by: list[str], schema: pa.Schema):
    """Texts to rows for the shards: one for each document, with what needs no shard, and one for each
    shard that holds some of the keys of a block of documents gathered."""
    def go(batches):
        task = TaskContext.get()
        uid = (task.partitionId() if task else 0) << 33
        names, values = hot.value
        held, tokens, first = [], 0, uid
        enough = max(GATHER, GATHER_SHARD * shards)

        def sent():
            row, key, n = _entries(*(np.concatenate(v) for v in zip(*held)))
            shard = _of_shard(key, shards)
            edge = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
            rows = [{"shard": int(shard[a]), "block": first, "keys": _squeezed_keys(key[a:z]), "rows": _squeezed(row[a:z]),
                     "counts": _squeezed(n[a:z])} for a, z in zip(edge[:-1], edge[1:])]
            return pa.RecordBatch.from_pylist(rows, schema)

        for b in batches:
            for part, w in chunks(b, "text", "space"):
                row, u, x = bigrams(w)
                n = w.counts() + 1
                key = word_key(x)
                if len(names):
                    at = np.minimum(np.searchsorted(names, key), len(names) - 1)
                    rare = names[at] != key
                    base = np.bincount(row[~rare], values[at[~rare]] * STEP, len(n))
                else:
                    rare, base = np.ones(len(key), bool), np.zeros(len(n))
                ids = uid + np.arange(len(n))
                empty = pa.nulls(len(n), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids % shards), pa.array(np.full(len(n), first)), pa.array(ids), empty, empty, empty, pa.array(n), pa.array(base + n * unknown),
                     *[part.column(c).cast(schema.field(k + 8).type) for k, c in enumerate(by)]], schema=schema)
                row = (row + (uid - first)).astype(np.uint32)
                held.append((np.concatenate([row[rare], row]), np.concatenate([key[rare], pair(u, x)])))
                uid, tokens = uid + len(n), tokens + len(held[-1][0])
                if tokens >= enough:
                    yield sent()
                    held, tokens, first = [], 0, uid
        if held:
            yield sent()
    return go


def _answered(schema: pa.Schema, shards: int):
    """One shard: documents pass, keys become partial sums of their documents, dealt to buckets of
    blocks."""
    def go(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return schema.empty_table()
        own = left.filter(left.column("uid").is_valid())
        bucket = pa.array(_of_bucket(own.column("block").to_numpy(), shards))
        empty = pa.nulls(len(own), pa.binary())
        docs = pa.Table.from_arrays([bucket, *[own.column(c) for c in ("block", "uid", "n", "lp")], empty, empty, *[own.column(f.name) for f in list(schema)[7:]]], schema=schema)
        keys = np.concatenate([np.zeros(0, np.uint64), *[_restored_keys(x) for x in right.column("keys").to_pylist()]])
        values = np.concatenate([np.zeros(0, np.int32), *[_restored(x, np.int32) for x in right.column("values").to_pylist()]])
        order = np.argsort(keys, kind="stable")  # a few sorted pieces
        keys, values = keys[order], values[order]
        rows = []
        for q in left.filter(left.column("keys").is_valid()).select(["block", "keys", "rows", "counts"]).to_batches(max_chunksize=64):
            for block, k, r, c in zip(*(q.column(i).to_pylist() for i in range(4))):
                total = np.bincount(_restored(r, np.uint32), _look(keys, values, _restored_keys(k)) * _restored(c, np.uint32))
                some = np.flatnonzero(total)
                if len(some):
                    rows.append({"bucket": int(_of_bucket(np.array([block]), shards)[0]), "block": block,
                                 "rows": _squeezed(some.astype(np.uint32)), "sums": _squeezed(total[some].astype(np.int64))})
        return pa.concat_tables([docs, pa.Table.from_pylist(rows, schema)])
    return go


def _of_bucket(block: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(block.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _summed(schema: pa.Schema):
    """One bucket: the documents with all their sums."""
    def go(t: pa.Table) -> pa.Table:
        docs, parts = t.filter(t.column("uid").is_valid()), t.filter(t.column("rows").is_valid())
        uid, lp = docs.column("uid").to_numpy(), docs.column("lp").to_numpy().copy()
        order = np.argsort(uid)
        if len(parts):
            steps = np.zeros(len(lp), np.int64)
            for block, r, s in zip(*(parts.column(c).to_pylist() for c in ("block", "rows", "sums"))):
                at = order[np.searchsorted(uid, _restored(r, np.uint32).astype(np.int64) + block, sorter=order)]
                steps[at] += _restored(s, np.int64)
            lp += steps * STEP
        return pa.Table.from_arrays([docs.column("n"), pa.array(lp), *[docs.column(f.name) for f in list(schema)[2:]]], schema=schema)
    return go


def _packed(t: pa.Table) -> pa.Table:
    order = np.argsort(key := t.column("key").to_numpy().view(np.uint64))
    return pa.table({"shard": t.column("shard").slice(0, 1), "keys": pa.array([_squeezed_keys(key[order])], pa.binary()),
                     "values": pa.array([_squeezed(t.column("value").to_numpy()[order].astype(np.int32))], pa.binary())})


class Shards:
    """A model cut by key: a written table with the sorted keys of each shard and their values, a row for
    each part of the model that has some, and the commonest words. ``spend``: each part of the model is
    deleted when it is packed, so that the model is not on disk twice."""

    def __init__(self, model: DataFrame, shard_rows: int = SHARD, spend: bool = False):
        spark = prepare(model.sparkSession)
        self.n = max(1, -(-model.count() // shard_rows))
        common = model.where("seen is not null").orderBy(F.desc("seen"), "key").limit(HOT).select("key", "value").toArrow()
        names, values = common.column("key").to_numpy().view(np.uint64), common.column("value").to_numpy()
        self.hot = spark.sparkContext.broadcast((np.sort(names), values[np.argsort(names)]))
        self.parts = []
        shard = F.shiftrightunsigned(F.shiftrightunsigned("key", 32) * F.lit(self.n).cast("long"), 32)
        for part in getattr(model, "_parts", [model]):
            held = part.select(shard.alias("shard"), "key", "value")
            self.parts.append(keep(held.groupBy("shard").applyInArrow(_packed, "shard long, keys binary, values binary"), "kn-shards"))
            if spend:
                drop(part)
        self.table = reduce(DataFrame.union, self.parts)


def perplexity(texts: DataFrame, model: DataFrame, unknown: float, shard_rows: int = SHARD) -> DataFrame:
    """``texts`` (key columns and text) with n_tokens and perplexity, the text dropped; a written table."""
    shards = Shards(model, shard_rows)
    out = scores(texts, shards, unknown)
    drop(*shards.parts)
    return out


def _shapes(info: list[T.StructField]) -> tuple[T.StructType, T.StructType, T.StructType]:
    """What goes to the shards, to the buckets, and comes out of them; ``info`` passes."""
    block, uid, n = (T.StructField(c, T.LongType()) for c in ("block", "uid", "n"))
    lp = T.StructField("lp", T.DoubleType())
    binary = lambda *names: [T.StructField(c, T.BinaryType()) for c in names]
    return (T.StructType([T.StructField("shard", T.LongType()), block, uid, *binary("keys", "rows", "counts"), n, lp, *info]),
            T.StructType([T.StructField("bucket", T.LongType()), block, uid, n, lp, *binary("rows", "sums"), *info]),
            T.StructType([n, lp, *info]))


def scores(texts: DataFrame, shards: Shards, unknown: float) -> DataFrame:
    """``perplexity`` with a model that is cut already."""
    by = [c for c in texts.columns if c != "text"]
    info = [T.StructField(f"by_{i}", texts.schema[c].dataType) for i, c in enumerate(by)]
    shape, found, out = _shapes(info)
    done = []
    for k in range(SLICES):
        mine = texts.where(F.pmod(F.xxhash64(*texts.columns, F.lit(5)), F.lit(SLICES)) == k)
        asked = mine.mapInArrow(_asked(shards.n, shards.hot, unknown, by, to_arrow_schema(shape)), shape)
        parts = asked.groupBy("shard").cogroup(shards.table.groupBy("shard")).applyInArrow(_answered(to_arrow_schema(found), shards.n), found)
        each = parts.groupBy("bucket").applyInArrow(_summed(to_arrow_schema(out)), out)
        done.append(keep(each.select(*[F.col(f.name).alias(c) for f, c in zip(info, by)], F.col("n").alias("n_tokens"),
                                     F.pow(F.lit(10.0), -F.col("lp") / F.col("n")).alias("perplexity")), "kn-scores"))
    return reduce(DataFrame.union, done)


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE,
            shard_rows: int = SHARD) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, lang): doc_id, lang, n_tokens, perplexity, threshold, keep."""
    texts = docs.select("doc_id", "lang", "text")
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    deal = F.pmod(F.xxhash64("doc_id"), F.lit(DEALS))
    trusted = [keep(texts.where(deal == k).join(good.where(half == 0), "doc_id", "left_semi").select("text"), "kn-trusted") for k in range(DEALS)]
    slices = counted(reduce(DataFrame.union, trusted))
    drop(*trusted)
    model, unknown = fitted(slices)
    shards = Shards(model, shard_rows, spend=True)
    scored = scores(texts, shards, unknown)
    drop(*shards.parts)
    unseen = scored.join(good.where(half == 1), "doc_id", "left_semi")
    by_lang = unseen.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10000).alias("own")).withColumnRenamed("lang", "l")
    any_lang = unseen.agg(F.percentile_approx("perplexity", quantile, 10000)).first()[0]
    out = scored.join(by_lang, F.expr("lang <=> l"), "left")
    return out.withColumn("threshold", F.coalesce("own", F.lit(any_lang).cast("double"))).select(
        "doc_id", "lang", "n_tokens", "perplexity", "threshold",
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("keep"))


def op6_quality_kn(spark, sf_dir):
    """One row per document: doc_id, lang, n_tokens, perplexity, threshold, keep."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
