"""The trie model and the Kneser-Ney classifier against plain Python models."""
import collections
import math
import random
import types
import zlib

import numpy as np
import pyarrow as pa
from llm_support import frame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tickscan.llm import quality_kn as Q
from tickscan.llm import trie_lm as M


def text(rnd, n, words=60):
    return " ".join("w%d" % min(rnd.randrange(words), rnd.randrange(words)) for _ in range(n))


def corpus(n=150, seed=4):
    rnd = random.Random(seed)
    rows = [(i, text(rnd, rnd.randrange(1, 80))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "Never Seen WORDS w1"), (None, "w1 w2"), (0, rows[0][1]), (3, "w1 other text")]


def tokens(t):
    return (t or "").encode().lower().split() + [None]


def learned(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


def pairs(t):
    x = tokens(t)
    return list(zip([None] + x[:-1], x))


def test_trie(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(M, "BATCH_TOKENS", 500)
    c, b = collections.Counter(), collections.Counter()
    for i, t in rows:
        if learned(i):
            c.update(tokens(t))
            b.update(pairs(t))
    n, v = sum(c.values()), len(c)
    n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
    d = min(0.9, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
    uni = lambda w: (c[w] - d) / n if c[w] else d * v / n
    want = [(i, i is not None and not learned(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
             sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)),
             sum(math.log10((b[p] + M.MU * uni(p[1])) / (c[p[0]] + M.MU)) for p in pairs(t))) for i, t in rows]
    docs = frame(spark, rows).repartition(3)
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    shaped = docs.select(F.col("doc_id").alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"),
                         F.coalesce(~learn, F.lit(False)).alias("held_out"), "text")
    trie, model, hot = M.train(shaped, shard_tokens=700)
    assert model["shards"] > 3
    got = [tuple(r) for r in M.score(shaped, trie, model, hot).collect()]
    key = lambda r: (str(r[0]), r[2], r[5])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 and abs(g[6] - w[6]) < 2e-4 * w[2], (g, w)
    assert sorted(map(str, M.trie_lm(docs, learn).select("doc_id").collect())) == sorted(str(F_) for F_ in docs.select("doc_id").collect())


def test_trie_without_training_text(spark):
    out = M.trie_lm(frame(spark, [(0, "a b"), (1, None)]), F.lit(False)).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in out) == [(0, 3, 0, 0), (1, 1, 0, 0)]
    assert M.trie_lm(frame(spark, []), F.lit(True)).collect() == []


def kneser_ney(train):
    b = collections.Counter(p for t in train for p in pairs(t))
    before, ctx = collections.Counter(w for _, w in b), collections.Counter()
    for (u, _), n in b.items():
        ctx[u] += n

    def discounts(counts):
        n = collections.Counter(counts)
        if not n[1] or not n[2]:
            return [0.5] * 3
        y = n[1] / (n[1] + 2 * n[2])
        d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        return [min(max(x, 0.1), i + 0.9) for i, x in enumerate(d)]

    d1, d2 = discounts(before.values()), discounts(b.values())
    less = lambda n, d: d[min(n, 3) - 1]
    total = sum(before.values())
    unknown = sum(min(n, less(n, d1)) for n in before.values()) / total / (len(before) + 1)
    cont = lambda w: (before[w] - min(before[w], less(before[w], d1))) / total + unknown if before[w] else unknown
    freed = collections.Counter()
    for (u, _), n in b.items():
        freed[u] += less(n, d2)

    def lp(u, w):
        if not ctx[u]:
            return math.log10(cont(w))
        back = freed[u] / ctx[u] * cont(w)
        return math.log10(max(b[(u, w)] - less(b[(u, w)], d2), 0) / ctx[u] + back if b[(u, w)] else back)
    return lp


def test_kneser_ney(spark):
    rows = [r for r in corpus() if r[0] is not None]
    train = [t for i, t in rows if i % 2]
    lp = kneser_ney(train)
    model, unknown = Q.train(frame(spark, rows).where("doc_id % 2 = 1").select("text"))
    texts = frame(spark, rows)
    for shard_rows in (10_000_000, 500):
        got = sorted(tuple(r) for r in Q.perplexity(texts, model, unknown, shard_rows).collect())
        want = sorted((i, len(tokens(t)), 10 ** (-sum(lp(*p) for p in pairs(t)) / len(tokens(t)))) for i, t in rows)
        assert len(got) == len(want)
        assert all(g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-6 * w[2] for g, w in zip(got, want))


def test_quality_keeps_clean_texts(spark):
    rnd = random.Random(9)
    rows = [(i, text(rnd, 80), "en" if i % 2 else None, 1) for i in range(400)]
    rows += [(400 + i, " ".join("junk%d" % rnd.randrange(10**6) for _ in range(80)), "en", 0) for i in range(40)]
    rows += [(500, None, "xx", None), (501, "", None, None), (None, rows[0][1], "en", None), (0, rows[0][1], None, None)]
    docs = spark.createDataFrame([r[:3] + (1,) for r in rows], "doc_id long, text string, lang string, threshold int")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, quality int")
    out = Q.quality(docs, labels).collect()
    assert len(out) == len(rows)
    kept = {r["doc_id"] for r in out if r["keep"]}
    assert len(kept & set(range(400))) >= 380 and not kept & set(range(400, 440))
    assert all(r["keep"] for r in Q.quality(docs, labels.limit(0)).collect())
    assert Q.quality(docs.limit(0), labels).collect() == []


def test_trie_hot_word_in_one_context(spark):
    """A word often seen, in one context only, is known in any other context and shard."""
    rows = [(i, "alpha hot") for i in range(1, 60)] + [(100 + i, "new%d hot" % i) for i in range(40)]
    docs = frame(spark, rows).select(F.col("doc_id").alias("id"), (F.col("doc_id") < 100).alias("learn"),
                                     (F.col("doc_id") >= 100).alias("held_out"), "text")
    trie, model, hot = M.train(docs, shard_tokens=10, hot_least=20)
    assert model["shards"] > 10 and len(hot.value[0]) == 3
    n, v = 3 * 59, 3
    discount, p_hot = model["discount"], (59 - model["discount"]) / n
    for r in M.score(docs, trie, model, hot).where("held_out").collect():
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in (0, 59, 59))
        score = (math.log10(M.MU * discount * v / n / (59 + M.MU)) + math.log10(M.MU * p_hot / M.MU)
                 + math.log10((59 + M.MU * p_hot) / (59 + M.MU)))
        assert r["n_known"] == 2 and abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - score) < 1e-3


def test_quality_learns_from_all_trusted_text(spark, monkeypatch):
    """Words of every trusted document of the training half are in the model."""
    ids = [i for i in range(25000) if zlib.crc32(str(i).encode()) % 2 == 0]
    assert len(ids) > 12000
    docs = frame(spark, [(i, "own%d" % i, "en") for i in ids], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    out = Q.quality(docs, labels).select("perplexity").distinct().collect()
    assert max(r[0] for r in out) < 1.01 * min(r[0] for r in out)


def test_quality_rows_that_share_an_id_and_many_shards(spark, monkeypatch):
    """Rows that share id, language and number of tokens keep their own perplexity, for any number of
    shards and of tokens gathered; equal rows score alike; very long and odd texts pass."""
    rnd = random.Random(4)
    rows = [(i, text(rnd, 60), "en") for i in range(60)]
    rows += [(777, rows[0][1], "en"), (777, " ".join(reversed(rows[0][1].split(" "))), "en"), (None, rows[1][1], "en"),
             (None, " ".join("zz%d" % k for k in range(len(rows[1][1].split()))), "en"), (5, rows[5][1], "en"), (5, rows[5][1], "en"),
             (900, "la " * 200_000, "en"), (901, None, None), (902, "", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = docs.withColumn("keys", F.lit("clash")).withColumn("uid", F.lit(None).cast("int"))
    model, unknown = Q.train(docs.where("doc_id < 40").select("text"))
    seen = []
    for gather, shard_rows in ((1_000_000, 10_000_000), (100, 50)):
        monkeypatch.setattr(Q, "GATHER", gather)
        monkeypatch.setattr(Q, "GATHER_SHARD", 1)
        monkeypatch.setattr(Q, "HOT", gather // 10)
        out = Q.perplexity(texts, model, unknown, shard_rows)
        assert out.columns == ["doc_id", "lang", "keys", "uid", "n_tokens", "perplexity"]
        seen.append(sorted((tuple(r) for r in out.collect()), key=str))
    assert len(seen[0]) == len(rows) == len(seen[1])
    assert all(a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * a[5] for a, b in zip(*seen))
    for i in (777, None):
        own = [r[5] for r in seen[0] if r[0] == i]
        assert len(own) == 2 and abs(own[0] - own[1]) > 0.01 * own[0]
    assert len({r[5] for r in seen[0] if r[0] == 5}) == 1 and len([r for r in seen[0] if r[0] == 5]) == 3


def test_quality_moves_trusted_texts_once_and_holds_the_model_once(spark, monkeypatch):
    """Pairs are counted from written texts, not from a join repeated for each slice; a part of the model is
    deleted when it is packed."""
    real_keep, real_drop, plans, live, most = Q.keep, Q.drop, [], [], []

    def keep(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        out = real_keep(df, name)
        live.append((name, out._kept_at))
        if name == "kn-shards":
            most.append(len([1 for n, _ in live if n in ("kn-model", "kn-shards")]))
        return out

    def drop(*tables):
        live[:] = [x for x in live if x[1] not in {t._kept_at for t in tables}]
        real_drop(*tables)

    monkeypatch.setattr(Q, "keep", keep)
    monkeypatch.setattr(Q, "drop", drop)
    rows = [r for r in corpus() if r[0] is not None]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int")
    assert Q.quality(docs, labels, shard_rows=100).count() == len(rows)
    counted = [p for n, p in plans if n == "kn-bigrams"]
    assert len(counted) == Q.SLICES and not any("Join" in p for p in counted)
    assert len(most) > 1 and max(most) <= Q.SLICES + 2
    assert {n for n, _ in live} == {"kn-scores"}


def test_quality_sums_take_less_than_the_keys_asked(monkeypatch):
    """With so many shards that a document has few keys in each, the sums that come back are smaller than
    what was sent, and complete."""
    rnd = random.Random(2)
    texts = [text(rnd, 100, 4000) for _ in range(300)]
    shards, hot = 97, types.SimpleNamespace(value=(np.zeros(0, np.uint64), np.zeros(0, np.int32)))
    shape, found, out = map(to_arrow_schema, Q._shapes([]))
    asks = list(Q._asked(shards, hot, -1.0, [], shape)([pa.RecordBatch.from_pydict({"text": texts})]))
    asked = pa.Table.from_batches(asks)
    want = [len(t.split()) + 1 for t in texts]
    one, parts = int(1 / Q.STEP), []
    for k in range(shards):
        left = asked.filter(pa.compute.equal(asked["shard"], k))
        sent = [Q._restored_keys(x) for x in left["keys"].drop_null().to_pylist()]
        key = np.unique(np.concatenate([np.zeros(0, np.uint64), *sent]))
        assert (Q._of_shard(key, shards) == k).all()
        pieces = [p for p in (key[::2], key[1::2]) if len(p)]  # as from two parts of a model; each key is worth 1
        right = pa.table({"shard": pa.array([k] * len(pieces), pa.int64()), "keys": pa.array([Q._squeezed_keys(p) for p in pieces], pa.binary()),
                          "values": pa.array([Q._squeezed(np.full(len(p), one, np.int32)) for p in pieces], pa.binary())})
        parts.append(Q._answered(found, shards)(left, right))
    back = pa.concat_tables(parts)
    size = lambda t, *names: sum(len(x) for c in names for x in t[c].drop_null().to_pylist())
    assert size(back, "rows", "sums") < size(asked, "keys", "rows", "counts")
    assert size(back, "rows", "sums") < 8 * sum(len(set(t.split())) + len(set(pairs(t))) for t in texts)
    got = [Q._summed(out)(back.filter(pa.compute.equal(back["bucket"], k))) for k in np.unique(back["bucket"].to_numpy())]
    got = [(n, lp) for t in got for n, lp in zip(t["n"].to_pylist(), t["lp"].to_pylist())]
    # a word and a pair for each token, less one for the token itself
    assert sorted(got) == sorted((n, float(n)) for n in want)
