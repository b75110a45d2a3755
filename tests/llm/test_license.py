"""Licence scan: base places against brute force, labels by templates."""
import re

from pyspark.sql import functions as F
from llm_support import SF, UPPER, frame

from tickscan.llm.license_scan import BASE, scan


def brute(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
    at, labels = [], set()
    for phrase, label in BASE.items():
        k = phrase.split()
        here = [j for j in range(len(w) - len(k) + 1) if w[j:j + len(k)] == k]
        at += here
        labels |= {label} if here else set()
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))


def rows_of(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in df.collect()), key=str)


ROWS = [(1, "Under the MIT License. under THE mit-license"), (2, "x apache license, version 2.0 y"), (3, "cc-by-nc cc by nc"), (4, None), (5, ""),
        (6, "under the mit licence"), (7, "This work is licensed under the GNU General Public License, version 3."), (8, "mit der mit und mit"),
        (None, "CC BY NC"), (1, "Under the MIT License. under THE mit-license"), (1, "other text"),
        (9, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files to deal in the Software without restriction")]


def test_brute(spark):
    out = scan(frame(spark, ROWS)).cache()
    assert rows_of(out) == sorted(((i, *brute(t)) for i, t in ROWS), key=str)
    labels = {r["doc_id"]: r["labels"] for r in out.where("doc_id in (7, 8, 9, 6)").collect()}
    assert labels == {6: "", 7: "gpl-3", 8: "", 9: "mit"}
    assert all(0 <= r["score"] <= 1 for r in out.collect())


def test_given_table_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert rows_of(scan(docs)) == sorted(((r[0], *brute(r[1])) for r in docs.collect()), key=str)
    assert scan(frame(spark, [])).collect() == []


def test_repeated_rows_change_nothing(spark):
    """Labels and score of a text do not depend on how often its row stands there; long texts, clashing names."""
    half = "redistribution and use in source and binary forms or so"
    whole = ROWS[-1][1]
    docs = [(1, half), (2, half), (2, half), (2, half), (2, half), (3, whole), (4, whole), (4, whole), (None, whole), (None, whole),
            (5, "word " * 100_000 + "under the mit license " + "word " * 100_000)]
    df = frame(spark, docs).withColumn("key", F.lit(1)).withColumn("labels", F.lit("x")).withColumn("start", F.lit(0))
    got = {}
    for r in scan(df).collect():
        got.setdefault(r["doc_id"], set()).add((r["labels"], r["score"], r["n_base"], r["first_word"]))
    assert got[1] == got[2] == {("", 0.0, 0, None)} and got[3] == got[4] == got[None] and {x[0] for x in got[3]} == {"mit"}
    assert got[5] == {("mit", 1.0, 1, 100_000)}
