"""Licence scan: positional index of the rarest licence words, aligned with templates.

Only built-in DataFrame functions, in three steps over whole texts:

1. document frequencies of all template words, counted over every document, give their IDF;
2. each template is indexed under its words of highest IDF with their positions. Every document
   position that holds such a word is joined with the postings, and postings are intersected by
   relative position: words that agree on where the template starts vote for one alignment;
3. an alignment with enough of the template's IDF weight is verified: one of the template's
   mandatory key phrases must stand, word by word, where the alignment puts it.

The three base phrases are templates whose key phrase is the whole template, so their places come
out of the same index. The index holds a fixed number of templates (``TEMPLATES``), so it is small
whatever the corpus; texts are never shuffled.

Defined cases: null or empty text has no words and no labels; rows that repeat an id are judged on
their own text; a null doc_id is judged like any other; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, table
from .sqlwords import row_key, word_count, words

# Phrases and labels of the contract.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Fixed values: (label, notice, mandatory key phrases) of common licences.
TEMPLATES = [
    ("mit", "released under the mit license", ["the mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction", ["granted free of charge", "in the software without restriction"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
                 "http www apache org licenses license 2 0", ["apache org licenses license 2"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ["commons attribution noncommercial"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ["commons attribution sharealike"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["commons attribution 4"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-3", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
              "foundation either version 3", ["gnu general public license as published"]),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3", ["gnu lesser general public license"]),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ["gnu affero general public license"]),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]

#: Words of highest IDF under which a template is indexed.
RARE = 4
#: Share of the indexed IDF weight that an alignment must reach.
COVER = 0.6


def template_words(spark: SparkSession, templates=TEMPLATES, base=BASE) -> DataFrame:
    """(t, label, base, size, word, tpos) and the key phrases of each template as (kpos, kwords)."""
    rows = []
    every = [(label, text, [text], True) for text, label in base.items()] + [(*x, False) for x in templates]
    for t, (label, text, keys, is_base) in enumerate(every):
        w = text.split()
        phrases = []
        for k in (key.split() for key in keys):
            at = next(i for i in range(len(w)) if w[i:i + len(k)] == k)
            phrases.append((at, k))
        rows += [(t, label, is_base, len(w), x, i, phrases) for i, x in enumerate(w)]
    return spark.createDataFrame(rows, "t int, label string, base boolean, size int, word string, tpos int, "
                                       "phrases array<struct<kpos:int,kwords:array<string>>>")


def postings(docs: DataFrame, tmpl: DataFrame, rare: int = RARE) -> DataFrame:
    """The index: the rarest words of each template with position and weight, by IDF over all ``docs``."""
    vocab = sorted({r["word"] for r in tmpl.select("word").distinct().collect()})  # fixed templates: some hundred words
    lit = F.array(*[F.lit(w) for w in vocab])
    df = (docs.select(F.explode(F.array_intersect(words(F.col("text")), lit)).alias("word")).groupBy("word").count())
    # some hundred rows from here on
    idf = tmpl.select("word").distinct().join(df, "word", "left").select(
        "word", F.log((docs.count() + 1.0) / (F.coalesce("count", F.lit(0)) + 0.5)).alias("idf"))
    rank = F.row_number().over(Window.partitionBy("t").orderBy(F.desc("idf"), "tpos"))
    # a base phrase is verified as a whole, so its rarest word finds all its places
    return tmpl.join(idf, "word").withColumn("rank", rank).where(F.col("rank") <= F.when(F.col("base"), 1).otherwise(rare))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, base=BASE,
         rare: int = RARE, cover: float = COVER) -> DataFrame:
    """One row for each document: id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, and ``places`` (label, start, size, score) of all verified alignments."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tmpl = template_words(spark, templates, base)
    index = keep(postings(docs, tmpl, rare), "licence-index")
    total = index.groupBy("t").agg(F.sum("idf").alias("all_idf"))
    w = docs.select("id", row_key(F.col("text")).alias("key"), words(F.col("text")).alias("w"))
    at = w.select("id", "key", "w", F.posexplode("w").alias("pos", "word"))
    small = F.broadcast(index.select("word", "t", "tpos", "idf"))  # len(templates) * rare rows
    votes = at.join(small, "word").withColumn("start", F.col("pos") - F.col("tpos"))
    shape = F.broadcast(tmpl.select("t", "label", "base", "size", "phrases").dropDuplicates(["t"]).join(total, "t"))
    # the key phrases are tested where the alignment puts them, before votes are summed
    right = F.exists("phrases", lambda p: (F.col("start") + p["kpos"] >= 0)
                     & (F.slice("w", F.greatest(F.col("start") + p["kpos"], F.lit(0)) + 1, F.size(p["kwords"])) == p["kwords"]))
    verified = votes.join(shape, "t").where(right)
    aligned = (verified.groupBy("id", "key", "t", "start", "label", "base", "size", "all_idf")
               # each word of the template votes once, however often its row is repeated
               .agg(F.collect_set(F.struct("tpos", "idf")).alias("votes"))
               .withColumn("got", F.aggregate("votes", F.lit(0.0), lambda a, v: a + v["idf"]))
               .withColumn("score", F.when(F.col("base"), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.col("got") / F.col("all_idf"))))
               .where(F.col("base") | (F.col("score") >= cover)))
    place = F.struct("label", "start", "size", F.round("score", 6).alias("score"))
    by_doc = aligned.groupBy("id", "key").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"), F.array_sort(F.collect_set(place)).alias("places"))
    by_doc = keep(by_doc.withColumnsRenamed({"id": "hit_id", "key": "hit_key"}), "licence-hits")
    rows = docs.select("id", row_key(F.col("text")).alias("key"), word_count(F.col("text")).alias("n_words"))
    return rows.join(by_doc, F.expr("id <=> hit_id and key = hit_key"), "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "places")


def op2_license_scan(spark, sf_dir):
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return scan(table(spark, sf_dir, "documents")).drop("places")
