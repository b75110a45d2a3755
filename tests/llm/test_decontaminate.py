"""Benchmark decontamination against brute force and its SQL."""
import hashlib
import re

import duckdb
from llm_support import SF, UPPER, frame

from tickscan.llm import decontaminate as D
from tickscan.llm.registry import ORACLES, QUERIES


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))


def brute(docs, items):
    grams = {}
    for i, t in items:
        w = words(t)
        k = min(13, len(w))
        for j in range(len(w) - k + 1) if w else ():
            grams.setdefault(tuple(w[j:j + k]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, its = words(t), set(), set()
        for k in {len(g) for g in grams}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in grams:
                    hit |= set(range(j, j + k))
                    its |= grams[tuple(w[j:j + k])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in its if x is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(spark, docs, items, **how):
    out = D.decontaminate(frame(spark, docs), frame(spark, items, "item_id long, text string"), **how)
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in out.collect()), key=str)


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(10, LONG), (2, "W3 w4-w5 w6 W7 w8 w9 w10 w11 w12 w13 w14 w15"), (3, "Short É item"), (4, None), (5, " .,"), (None, "nobody knows")]
DOCS = [(1, LONG), (2, "x " * 500 + LONG), (3, "x " * 700 + LONG), (4, "a short É item, a SHORT É ITEM"), (5, "short é item"), (6, None),
        (7, ""), (8, "nobody knows"), (None, LONG), (9, LONG), (9, "clean words only"), (1, LONG)]


def test_brute(spark):
    assert got(spark, DOCS, ITEMS) == brute(DOCS, ITEMS)
    assert got(spark, DOCS, ITEMS, ) == got(spark, DOCS, list(reversed(ITEMS)))


def test_slices_of_the_broadcast(spark):
    w = D.benchmark_windows(frame(spark, ITEMS, "item_id long, text string"), "item_id", "text").cache()
    docs = frame(spark, DOCS).withColumnRenamed("doc_id", "id")
    one, many = (sorted(map(str, D.hits(docs, w, n).collect())) for n in (1000, 4))
    assert one == many and one


def test_empty_tables(spark):
    assert got(spark, [], ITEMS) == []
    assert got(spark, DOCS[:2], []) == brute(DOCS[:2], [])


def test_remove_keeps_columns(spark):
    docs = spark.createDataFrame([(1, LONG, 1, "k"), (2, "clean", 2, "k"), (None, None, 3, None)], "doc_id long, text string, key int, w string")
    out = D.remove_contaminated(docs, frame(spark, ITEMS, "item_id long, text string"))
    assert out.columns == docs.columns and sorted(r["key"] for r in out.collect()) == [2, 3]


def test_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rows = sorted(map(tuple, QUERIES["op7_decontaminate"](spark, SF).collect()))
    assert rows == sorted(con.execute(ORACLES["op7_decontaminate"]).fetchall())
    assert all(r[4] == hashlib.sha256(b"").hexdigest() for r in rows if not r[3])
