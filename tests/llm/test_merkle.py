"""Merkle manifest against its SQL and a plain tree, for two and three to a run."""
import hashlib
import zlib

import duckdb
import pytest
from llm_support import SF

from tickscan.llm.merkle import folded, leaf, manifest, op12_merkle_manifest
from tickscan.llm.registry import ORACLES, QUERIES
from pyspark.sql import functions as F


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes, arity):
    """(root, proofs by leaf)."""
    of = [[i] for i in range(len(nodes))]
    proofs = ["" for _ in nodes]
    while len(nodes) > 1:
        up, up_of = [], []
        for i in range(0, len(nodes), arity):
            run = nodes[i:i + arity]
            for j in range(len(run)):
                for k in of[i + j]:
                    proofs[k] += "".join(run[:j] + run[j + 1:])
            up.append(h(*run))
            up_of.append([k for m in of[i:i + arity] for k in m])
        nodes, of = up, up_of
    return nodes[0], proofs


def told(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows, arity):
    """rows (doc_id, source, lang, n_chars, text) -> sorted (doc_id, leaf, subroot, root, proof digest)."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, h(*map(told, r)), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([m[2] for m in sorted(by[x], key=lambda m: m[:3])], arity) for x in langs}
    root, above = tree([trees[x][0] for x in langs], arity) if langs else (None, [])
    out = []
    for i, x in enumerate(langs):
        for m, p in zip(sorted(by[x], key=lambda m: m[:3]), trees[x][1]):
            out.append((m[3][0], m[2], trees[x][0], root, h(p + above[i])))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = QUERIES["op12_merkle_manifest"](spark, SF)
    rel = con.sql(ORACLES["op12_merkle_manifest"])
    at = [rel.columns.index(c) for c in df.columns]
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted(tuple(r[i] for i in at) for r in rel.fetchall())
    rows = con.sql("select doc_id, source, lang, n_chars, text from documents").fetchall()
    assert sorted((r[:5] for r in got), key=str) == brute(rows, 2)
    for r in got:
        assert r[6] == (zlib.crc32(str(r[0]).encode()) % 7 != 0)


ODD = ([(i, "s", "en", i, f"t{i}") for i in range(37)] + [(5, "s", "en", 5, "t5")] * 9 + [(None, None, None, None, None)] * 3
       + [(1, "", "", 0, "")] + [(i, "ü", "fr", None, "é" * i) for i in range(5)] + [(7, "s", "Z", 1, "a:b"), (7, "s", "Z", 1, "a")])


@pytest.mark.parametrize("arity", [2, 3])
def test_odd_rows(spark, arity):
    docs = spark.createDataFrame(ODD, SCHEMA).withColumn("tree", F.lit(4)).withColumn("digest", F.lit("x"))
    rows = docs.select("doc_id", "lang", leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("leaf"))
    m = manifest(rows, "lang", "doc_id", "leaf", arity)
    out = m.select("doc_id", "leaf", "subroot", "root", F.sha2(F.concat("in_group", "in_root"), 256),
                   folded(m, "leaf", arity).alias("again"), folded(m, "subroot", arity).alias("other")).collect()
    assert all(r["again"] == r["root"] and (r["other"] != r["root"] or r["leaf"] == r["subroot"]) for r in out)
    assert sorted((tuple(r)[:5] for r in out), key=str) == brute(ODD, arity)


def test_small(spark, tmp_path):
    for k, rows in enumerate(([], ODD[:1], ODD[:2])):
        at = f"{tmp_path}/{k}"
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{at}/documents.parquet")
        got = op12_merkle_manifest(spark, at).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows, 2)


def test_long_text(spark):
    text = "ab é" * 300_000
    d = spark.createDataFrame([(1, "s", "en", 3, text)], SCHEMA)
    assert d.select(leaf(*map(F.col, d.columns))).first()[0] == h(*map(told, (1, "s", "en", 3, text)))
