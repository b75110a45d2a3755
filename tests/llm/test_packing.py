"""Packing: ids against the plain tokenizer, whole and gapless sequences, their number."""
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import SF, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickscan.llm.packing import CAPACITY, Search, best_fit, best_fit_packing, pack, sequences, token_ids
from tickscan.llm.registry import QUERIES

PLAIN = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


def layout(rows, capacity=CAPACITY):
    """Checks that sequences are gapless and not too long; returns their number."""
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at <= capacity
    return len(seqs)


def test_query(spark):
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    df = QUERIES["op13_best_fit_packing"](spark, SF)
    assert dict(df.dtypes) == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                               "sequence_id": "bigint", "offset": "bigint"}
    rows = df.collect()
    want = []
    for i, t in texts.items():
        ids = np.array(ids_of(t), "<u4")
        want += [(i, k, s, len(ids[s:s + CAPACITY]), zlib.crc32(ids[s:s + CAPACITY].tobytes())) for k, s in enumerate(range(0, len(ids), CAPACITY))]
    assert sorted(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows) == sorted(want)
    assert layout(rows) == -(-sum(r["length"] for r in rows) // CAPACITY)


ODD = ["", " \n", "Don't STOP", "a b c\x85d", "é ́e", "ΑΣ ΣΑΣ.", "İI ǅ", "<|endoftext|>x <|startoftext|>", "日本 語x1234",
       "x" * 5000, "'s 't ' s", "👩‍👩‍👧 a\x1cb\x0bc", "don 't", "Stop.", "a.b, c..;x! 1,5. é, '.", "x,", ",y .,", "it's, 's.t", "A\u030a, K, <|STARTOFTEXT|>, B", "ABC,"]


def test_ids_of_odd_texts():
    data = [t.encode() for t in ODD]
    off = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    ids, ends = token_ids(np.frombuffer(b"".join(data), np.uint8), off)
    assert [ids[ends[i]:ends[i + 1]].tolist() for i in range(len(ODD))] == [ids_of(t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text() | st.text("aB1'.,;!? é<|>\u0301", max_size=12), max_size=6))
def test_ids_of_any_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    data = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(d) for d in data], dtype=np.int64)])
    ids, ends = token_ids(np.frombuffer(b"".join(data), np.uint8), off)
    assert [ids[ends[i]:ends[i + 1]].tolist() for i in range(len(texts))] == [ids_of(t) for t in texts]


def test_rows_texts_and_sequences(spark):
    rows = [(1, "a b", 1), (1, "a b", 1), (None, None, 2), (None, "", 2), (2, "word " * 9000, 3), (3, "A  b", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = best_fit_packing(docs, with_ids=True, capacity=100)
    got = out.collect()
    assert layout(got, 100) == -(-sum(r["length"] for r in got) // 100)
    assert sorted(r["length"] for r in got if r["doc_id"] is None) == [1, 1]
    assert sum(r["length"] for r in got if r["doc_id"] == 2) == 9001
    whole = {r["sequence_id"]: r["ids"] for r in sequences(out).collect()}
    for r in got:
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]
    assert best_fit_packing(frame(spark, [])).collect() == []


def test_search_empties_bins_by_exchange():
    size = np.array([50, 30, 20, 55, 40, 60, 45], np.int64)  # 300 in all, four bins at first
    bins = np.array([0, 0, 1, 1, 2, 3, 2])
    at = Search(size, bins, 100).run()
    assert len(set(at.tolist())) == 3 and np.bincount(at, size).max() == 100
    # 6 + 6 of the donor for the 11 of another bin: no single piece of it fits or helps
    size = np.array([6, 6, 11, 8, 9, 10, 10, 20], np.int64)  # 80 in bins of 20
    at = Search(size, np.array([0, 0, 1, 1, 2, 2, 3, 4]), 20).run()
    assert np.bincount(at, size).max() <= 20 and len(set(at.tolist())) <= 5


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_search_keeps_whole(sizes):
    size = np.array(sizes, np.int64)
    start = best_fit(size, 30)
    at = Search(size, start, 30).run()
    assert np.bincount(at, size).max() <= 30
    assert -(-size.sum() // 30) <= len(set(at.tolist())) <= len(set(start.tolist()))


def test_rounds(spark):
    r = random.Random(5)
    sizes = [r.choice([1, 7, 300, 700, 900, 1100, 1500, 2000, 2048, r.randrange(1, 2048)]) for _ in range(3000)]
    pieces = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    rows = pack(pieces, group=300).join(pieces, "uid").collect()
    assert len(rows) == 3000
    together = len(set(best_fit(np.array([x for x in sizes if x < CAPACITY], np.int64)).tolist())) + sizes.count(CAPACITY)
    assert layout(rows) <= 1.005 * together  # ten groups and their rounds do as well as one
    wide = spark.range(500).select(F.col("id").alias("uid"), F.lit(1025).cast("long").alias("length"))
    assert layout(pack(wide, group=100).join(wide, "uid").collect()) == 500
