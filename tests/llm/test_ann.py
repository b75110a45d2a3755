"""Multiprobe neighbours: recall against brute force, exact scores, odd vectors, copies."""
import itertools
import random

import numpy as np
from llm_support import SF
from pyspark.sql import functions as F

from tickscan.llm import ann as A
from tickscan.llm.registry import QUERIES


def brute(rows, q, k):
    own = np.array(dict(rows)[q], float)
    near = sorted((float(np.sqrt(((np.array(v, float) - own) ** 2).sum())), i) for i, v in rows if i != q)
    return near[:k]


def test_perturbations_come_in_order_of_cost():
    x = np.array([0.1, 0.45, 0.8])
    cost = lambda s: sum(x[i] ** 2 if d < 0 else (1 - x[i]) ** 2 for i, d in s)
    every = [tuple((i, d) for i, d in enumerate(c) if d) for c in itertools.product((-1, 0, 1), repeat=3)]
    got = A.perturbations(x, 27)
    assert sorted(map(sorted, got)) == sorted(map(sorted, every))
    assert np.allclose([cost(s) for s in got], sorted(cost(s) for s in every))


def test_recall_on_the_given_table(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {}
    for r in QUERIES["op8_multiprobe_ann"](spark, SF).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    hit = total = 0
    for q in (i for i, _ in rows if i % 100 == 0):
        want = brute(rows, q, 10)
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        vec = dict(rows)
        assert all(abs(np.linalg.norm(np.array(vec[v], float) - np.array(vec[q], float)) - s) < 1e-12 for _, s, v in mine)
        hit += len({i for _, i in want} & {m[2] for m in mine})
        total += len(want)
    assert hit >= 0.9 * total


def test_copies_and_odd_vectors(spark):
    rnd = random.Random(1)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 400)] + [(400 + i, [rnd.random() for _ in range(3)]) for i in range(20)]
    odd = [(900, None), (901, []), (902, [0.0, 0.0, 0.0]), (903, [1.0, None, 2.0]), (904, [1.0, float("nan"), 2.0]),
           (905, [float("inf"), 1.0, 2.0]), (906, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (400, rows[400][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, ids int")
    q = df.where("vec_id in (0, 5, 399, 400, 900, 903, 906)")
    got = {}
    for r in A.search(df, q, block=64).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [0, 5, 399, 400]
    assert [v for _, v, _ in sorted(got[0])] == list(range(1, 11))
    assert [v for _, v, _ in sorted(got[5])] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert A.search(df.limit(0), df.limit(0)).collect() == []
    few = df.where("vec_id < 3")
    assert len(A.search(few, few).collect()) == 6


def recall(spark, rows, queries, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in A.search(df, df.where(F.col("vec_id").isin(queries)), **how).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert all(len(got[q]) == 10 for q in queries)
    return sum(len({i for _, i in brute(rows, q, 10)} & set(got[q])) for q in queries) / (10 * len(queries))


def test_any_scale_and_clusters(spark):
    """Vectors times 10 and 0.05 are searched like the given ones; clusters; rows far from all others."""
    given = [(r[0], [float(x) for x in r[1]]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    queries = [i for i, _ in given if i % 100 == 0]
    for scale in (10.0, 0.05):
        assert recall(spark, [(i, [scale * x for x in v]) for i, v in given], queries) >= 0.9
    g = np.random.default_rng(2)
    centres = g.normal(size=(20, 16)) * 5
    rows = [(i, (centres[i % 20] + g.normal(size=16) * 0.3).tolist()) for i in range(2000)] + [(5000 + i, (np.eye(16)[i] * 1000).tolist()) for i in range(3)]
    assert recall(spark, rows, [i for i in range(0, 2000, 50)] + [5000]) >= 0.9


def test_few_finds_are_filled_up(spark):
    """With cells far too narrow each query still gets its exact 10 nearest."""
    g = np.random.default_rng(3)
    rows = [(i, g.normal(size=8).tolist()) for i in range(300)]
    assert recall(spark, rows, [0, 7, 90], width=1e-3) == 1.0
