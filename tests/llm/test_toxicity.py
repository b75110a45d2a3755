"""Positive-unlabelled toxicity: held-out accuracy on given labels, risk, odd rows."""
import random

import numpy as np
from llm_support import frame

from tickscan.llm import toxicity as X


def corpus(n=600, seed=2):
    rnd = random.Random(seed)
    clean = ["w%d" % i for i in range(300)]
    bad = ["vermin", "lowlife", "grunzling"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = [rnd.choice(clean) for _ in range(60)]
        if toxic:
            for _ in range(3):
                w[rnd.randrange(60)] = rnd.choice(bad) + rnd.choice(["", "heit", "ung", "lich"])
        rows.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out(spark):
    rows, labels = corpus()
    docs, marks = frame(spark, rows), frame(spark, labels, "doc_id long, toxic int")
    learn = X.fold(X.F.col("doc_id"), 4) != 2
    out = X.score(docs, X.fit(docs, marks, learn)).collect()
    toxic = np.array([r["doc_id"] % 5 == 0 for r in out])
    said = np.array([r["toxic_score"] >= X.THRESHOLD for r in out])
    assert (said & toxic).sum() >= 0.95 * toxic.sum() and (said & ~toxic).sum() <= 0.02 * (~toxic).sum()


def test_odd_rows(spark):
    rows, labels = corpus(200)
    rows += [(1000, None), (1001, ""), (None, rows[0][1]), (0, rows[0][1])]
    docs = spark.createDataFrame([(*r, 5, "a") for r in rows], "doc_id long, text string, toxic int, toxic_score string")
    marks = frame(spark, labels + [(0, None), (None, 1), (1, 0), (4, 1), (4, 0)], "doc_id long, toxic int")
    kept = X.remove_toxic(docs, marks)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1000 in ids and 1001 in ids and None not in ids and 0 not in ids
    none = marks.where("toxic = 7")
    assert {r["toxic_score_"] for r in X.score(docs, X.fit(docs, none), "toxic_score_").collect()} == {0.0}
    assert X.remove_toxic(docs.limit(0), marks).collect() == []


def test_risk_is_not_driven_below_zero():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 40, 12)).astype(np.int32) for _ in range(300)]
    toxic = np.arange(300) < 60
    names, w, bias = X.risk_fit(rows, toxic, 0.2)
    z = np.array([bias + sum(w[names == f][0] for f in r if f in names) for r in rows])
    lost = np.logaddexp(0, z)
    assert lost[~toxic].mean() - 0.2 * lost[toxic].mean() > -0.05
