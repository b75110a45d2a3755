"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier is trained with numpy from texts confirmed as toxic and from unlabelled texts.
The risk of calling an unlabelled text negative is corrected by the class prior, since a share of
the unlabelled texts is toxic; where the corrected negative risk falls below zero the step goes the
other way (Kiryo and others, 2017). Features are the distinct words of the whole text and the
first bytes of longer words, counted by how many distinct words share them: this catches insults
that are inflected.

Only the fit sees a sample: at most ``MAX_TOXIC`` confirmed and ``MAX_UNLABELLED`` unlabelled
documents, those of smallest hashed id. The documents of the sample that hold a feature are counted on
the executors first; the ``MAX_CANDIDATES`` features that most of them hold (at least ``LEAST_DOCS``)
are the only ones that reach the driver, so that its memory is bounded by documents times candidates,
whatever the texts. The fitted model is a sorted list of at most ``MAX_FEATURES`` feature hashes with weights; every task scores
whole texts with it, without a shuffle.

Defined cases: null or empty text has no features and gets the score of the bias; a null doc_id is
never learned from, its row is scored; labels that are null are not confirmed; a document with
several label rows is confirmed if any says so; without confirmed texts all scores are 0; empty
tables and extra columns are harmless.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, table, with_field
from .words import Words, chunks, lists, mix

MAX_TOXIC = 2500
MAX_UNLABELLED = 5000
MAX_FEATURES = 20000
MAX_CANDIDATES = 300_000
#: Entries of the sample handled at once by the fit.
CHUNK = 1 << 20
#: A document with at least this score is rejected.
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7, 8)
#: Bias of a model without confirmed texts.
NEVER = -1000.0
#: Documents of the sample that must hold a feature.
LEAST_DOCS = 4


def fold(doc_id: Column, of: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def _distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each (row, hash), and how often it stands."""
    _, at, n = np.unique(mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    return at, n


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature), each once, a feature being 32 bits of its hash: the distinct words of a row; the prefixes of its longer words,
    and again as features of their own those that two and three distinct words share."""
    at, _ = _distinct(w.row(), w.hash)
    row, start, size = w.row()[at], w.start[at], (w.end - w.start)[at]
    rows, out = [row], [w.hash[at]]
    for n in PREFIXES:
        long = np.flatnonzero(size > n)
        h = mix(w.piece_hash(start[long], n) + np.uint64(n))
        first, times = _distinct(row[long], h)
        for least in (1, 2, 3):
            some = first[times >= least]
            rows.append(row[long][some])
            out.append(mix(h[some] + np.uint64(least)))
    return np.concatenate(rows), (np.concatenate(out) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _held_by(batches):
    """(feature, documents that hold it) by chunk of texts."""
    for b in batches:
        for _, w in chunks(b, "text", "alnum"):
            row, h = features(w)
            _, first = np.unique((row.astype(np.uint64) << np.uint64(32)) | h.view(np.uint32), return_index=True)
            f, n = np.unique(h[first], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(n)], ["f", "n"])


def _sample_features(names):
    def go(batches):
        for b in batches:
            for rows, w in chunks(b, "text", "alnum"):
                row, h = features(w)
                known = names.value
                if len(known):
                    held = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
                    row, h = row[held], h[held]
                own = [np.unique(h[row == i]) for i in range(len(rows))]
                yield pa.RecordBatch.from_arrays([rows.column("toxic").cast(pa.int32()), lists(own, np.int32)], ["toxic", "f"])
    return go


def _spread(of: np.ndarray, value: np.ndarray, by: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``value[by]`` for each of ``n`` places ``of``."""
    out = np.zeros(n)
    for a in range(0, len(of), CHUNK):
        out += np.bincount(of[a:a + CHUNK], value[by[a:a + CHUNK]], n)
    return out


def _descend(col, of_row, n_rows, toxic, prior, w, bias, steps, rate, sparse):
    """Adam steps on the non-negative risk with an L1 proximal step."""
    n_pos, n_unl = int(toxic.sum()), int((~toxic).sum())
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        z = _spread(of_row, w, col, n_rows) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        lost = np.logaddexp(0, z)  # loss of calling a row negative
        if lost[~toxic].mean() >= prior * lost[toxic].mean():
            g = np.where(toxic, prior * (p - 1) / n_pos - prior * p / n_pos, p / n_unl)
        else:  # the corrected negative risk is below zero: climb back
            g = np.where(toxic, prior * p / n_pos, -p / n_unl)
        grad = np.append(_spread(col, g, of_row, len(w)), g.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        size = rate / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-4)
        move = size * first / (1 - 0.9 ** step)
        w, bias = w - move[:-1], bias - move[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - size[:-1] * sparse, 0)
    return w, bias


def risk_fit(rows: list[np.ndarray], toxic: np.ndarray, prior: float, sparse: float = 1e-3,
             steps: int = 100, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature hashes, weights, bias) that lower the non-negative risk of the sample.

    ``toxic`` tells confirmed rows from unlabelled ones. A first descent with an L1 norm of weight
    ``sparse`` picks the features, a second one fits them nearly without it.
    """
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    names, held = np.unique(flat, return_counts=True)
    names = names[held >= LEAST_DOCS]
    col = np.searchsorted(names, flat).astype(np.int32)
    use = np.flatnonzero(names[np.minimum(col, len(names) - 1)] == flat) if len(names) else np.zeros(0, int)
    of_row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])[use]
    col = col[use]
    bias = float(np.log(prior / (1 - prior)))

    def only(good):
        new, use = np.cumsum(good) - 1, good[col]
        return names[good], new[col[use]], of_row[use]

    if not toxic.any() or toxic.all() or not len(names):
        return names[:0], np.zeros(0), bias if toxic.any() else NEVER
    w, bias = _descend(col, of_row, len(rows), toxic, prior, np.zeros(len(names)), bias, steps, rate, sparse)
    strong = np.zeros(len(names), bool)
    strong[np.argsort(-np.abs(w))[:MAX_FEATURES]] = True
    strong &= w != 0
    names, col, of_row = only(strong)
    w, bias = _descend(col, of_row, len(rows), toxic, prior, w[strong], bias, 3 * steps, rate, sparse / 40)
    return names, w, bias


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, prior: float | None = None,
        max_toxic: int = MAX_TOXIC, max_unlabelled: int = MAX_UNLABELLED) -> tuple[np.ndarray, np.ndarray, float]:
    """Train on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); ``learn`` limits the rows whose
    labels and texts may be used. The prior is the confirmed share of labelled rows if not given."""
    learn = F.col("doc_id").isNotNull() if learn is None else learn
    marks = (labels.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    if prior is None:
        share = marks.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
        prior = min(0.5, max(1e-3, share or 0.0))
    by_hash = F.xxhash64("doc_id", F.lit(7))
    pos = marks.where("toxic = 1").select("doc_id").orderBy(by_hash, "doc_id").limit(max_toxic)
    unl = docs.where(learn).select("doc_id").distinct().orderBy(by_hash, "doc_id").limit(max_unlabelled)
    picked = pos.withColumn("toxic", F.lit(1)).union(unl.withColumn("toxic", F.lit(0)))
    # at most max_toxic + max_unlabelled ids
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("toxic", "text")
    common = (texts.mapInArrow(_held_by, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS)
              .orderBy(F.desc("n"), "f").limit(MAX_CANDIDATES).select("f").toArrow())
    names = docs.sparkSession.sparkContext.broadcast(np.sort(common.column("f").to_numpy()))
    got = texts.mapInArrow(_sample_features(names), "toxic int, f array<int>").toArrow()
    toxic = got.column("toxic").to_numpy().astype(bool)
    f = got.column("f").combine_chunks() if len(got) else pa.array([], pa.list_(pa.int32()))
    off, flat = (f.offsets.to_numpy(), f.values.to_numpy()) if len(got) else (np.zeros(1, int), np.zeros(0, np.int32))
    return risk_fit([flat[off[i]:off[i + 1]] for i in range(len(off) - 1)], toxic, prior)


def _scores(model):
    names, weight, bias = model

    def run(batches):
        for b in batches:
            for rows, w in chunks(b, "text", "alnum"):
                row, h = features(w)
                z = np.full(len(rows), bias)
                if len(names) and len(h):
                    at = np.minimum(np.searchsorted(names, h), len(names) - 1)
                    hit = names[at] == h
                    z += np.bincount(row[hit], weight[at[hit]], len(rows))
                score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                if bias == NEVER:
                    score[:] = 0
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(score)], [*rows.schema.names, "_score"])
    return run


def score(docs: DataFrame, model, name: str = "toxic_score") -> DataFrame:
    """``docs`` with the column ``name``, made from its column text."""
    return docs.mapInArrow(_scores(model), with_field(docs, name, T.DoubleType()))


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, learn: Column | None = None) -> DataFrame:
    """``docs`` without the rows that a model trained on them and ``labels`` rejects."""
    name = free_name(docs, "toxic_score")
    return score(docs, fit(docs, labels, learn), name).where(F.col(name) < threshold).drop(name)


def op3_toxicity(spark, sf_dir):
    """One row per document: doc_id, held_out, score, predicted."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    learn = fold(F.col("doc_id"), 4) != 2
    out = score(docs.select("doc_id", "text"), fit(docs, labels, learn))
    return out.select("doc_id", F.coalesce(~learn, F.lit(False)).alias("held_out"), F.col("toxic_score").alias("score"),
                      (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"))
