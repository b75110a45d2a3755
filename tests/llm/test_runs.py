"""Periodic runs against brute force: every stretch and period of small texts."""
import hashlib
import random
import re
import zlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import SF, frame

from tickscan.llm.registry import QUERIES
from tickscan.llm.runs import _rows, digests, runs, strongest

import pyarrow as pa

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(w):
    """All (start, length, period) by definition."""
    n, found = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q if j > i else 0
            if length >= max(6, 4 * q):
                part = w[i:i + length]
                if not any(all(part[x] == part[x + p] for x in range(length - p)) for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    found.sort(key=lambda r: (r[0], r[2]))
    kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n_ for s, n_, q in found)]
    return found, " ".join(kept)


def expected(doc_id, text, planted=True):
    w = WORD.findall(text or "")
    if planted and doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            n = len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found, kept = brute(w)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    return (doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def test_query(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' where strlen(text) < 6000").fetchall()
    got = {r[0]: tuple(r) for r in QUERIES["op11_runs"](spark, SF).collect()}
    assert len(got) == duckdb.sql(f"select count(*) from '{SF}/documents.parquet'").fetchall()[0][0]
    for i, t in rows:
        assert got[i] == expected(i, t)
    assert sum(got[i][1] > 0 for i, _ in rows) > 5


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), min_size=1, max_size=5))
def test_small_alphabet(texts):
    texts = [" ".join(t) for t in texts]
    assert list(_rows(pa.array(texts))) == [(f, k.encode()) for f, k in (brute(t.split()) for t in texts)]


def test_nested_and_neighbouring_texts():
    r = random.Random(3)
    block = lambda k: [f"w{r.randrange(4)}" for _ in range(k)]
    texts = []
    for _ in range(60):
        inner = block(2) * r.randrange(4, 7)
        texts.append(" ".join(block(5) + (inner + block(1)) * r.randrange(1, 6) + block(4)))
    texts += ["x y x y", "x y x y x y x y", None, "", " \t\r\n"]
    assert list(_rows(pa.array(texts))) == [(f, k.encode()) for f, k in (brute((t or "").split()) for t in texts)]


def test_odd_rows(spark):
    long = " ".join(f"u{i}" for i in range(50_000)) + " la" * 100_000 + " é \x1c é"
    rows = [(1, "a\x0b" * 6, 5), (None, None, 1), (None, "", 1), (2, "A a " * 8, 3), (2, "A a " * 8, 3), (2, "A a", 3), (3, long, 0),
            (4, "a b a b a b a b c d c d c d c d", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    out = runs(docs)
    assert out.columns == ["doc_id", "text", "runs", "runs_", "collapsed"]
    got = sorted(((r["doc_id"], [tuple(s) for s in r["runs_"]], r["collapsed"][-8:]) for r in out.collect()), key=str)
    assert got == sorted([(1, [(0, 6, 1)], "a"), (None, [], ""), (None, [], ""), (2, [(0, 16, 2)], "A a"), (2, [(0, 16, 2)], "A a"),
                          (2, [], "A a"), (3, [(50_000, 100_000, 1)], "la é \x1c é"), (4, [(0, 8, 2), (8, 8, 2)], "a b c d")], key=str)
    best = [r for r in digests(docs).collect() if r["doc_id"] == 4][0]
    assert (best["start"], best["length"], best["period"], best["exponent_milli"]) == (0, 8, 2, 4000)  # a tie: the first
    assert digests(frame(spark, [])).collect() == []
    assert strongest([(5, 9, 2), (0, 18, 4), (1, 9, 2)]) == (0, 18, 4)
