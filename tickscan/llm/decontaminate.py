"""Benchmark decontamination: windows of 13 words of test items, looked up in every document.

Only built-in DataFrame functions. The windows of all items are hashed into a set that is broadcast
in slices of at most ``SLICE`` hashes (the number of windows is counted first, so what one
broadcast holds has a fixed bound whatever the benchmark's size). Every word position of every whole
document makes a window hash; hits are verified word by word and merged into spans. Texts are
never shuffled: what leaves the scan are hits, joined to one short row for each document.

Defined cases: null or empty text has no words and no hits; items without words have no window and
an item of fewer than 13 words is one window; rows that repeat an id are judged each on their own
text; a null doc_id is judged like any other; items with null item_id mark words as hit but are not
listed; empty tables give no hits or no rows; extra columns are ignored, or kept by ``remove``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, table
from .sqlwords import row_key, word_count, words

WINDOW = 13
#: Window hashes in one broadcast (about 100 MB at most).
SLICE = 2_000_000
#: A document is contaminated if it has a hit and at least one of so many words is hit.
SHARE = 20


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """(item_id, size, gram, h): the distinct windows of each item."""
    w = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    w = w.withColumn("size", F.least(F.size("w"), F.lit(size)))
    at = w.select("item_id", "size", "w", F.explode(F.expr("sequence(1, size(w) - size + 1)")).alias("i"))
    return (at.select("item_id", "size", F.expr("slice(w, i, size)").alias("gram")).distinct()
            .withColumn("h", F.xxhash64("gram")))


def _document_windows(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(id, key, pos, size, h, gram) of every word position and window size; pos counts from 0."""
    w = docs.select("id", row_key(F.col("text")).alias("key"), words(F.col("text")).alias("w"))

    def one(size: int) -> DataFrame:
        at = w.where(F.size("w") >= size).select("id", "key", "w", F.explode(F.expr(f"sequence(1, size(w) - {size - 1})")).alias("i"))
        return at.select("id", "key", (F.col("i") - 1).alias("pos"), F.lit(size).alias("size"), F.expr(f"slice(w, i, {size})").alias("gram"))

    return reduce(DataFrame.unionByName, [one(s) for s in sizes]).withColumn("h", F.xxhash64("gram"))


def hits(docs: DataFrame, windows: DataFrame, slice_rows: int = SLICE) -> DataFrame:
    """(id, key, pos, size, item_id): verified occurrences of benchmark windows in documents."""
    hashes = windows.select("h", "size").distinct()
    known = hashes.groupBy("size").count().collect()  # one row for each window size: 13 at most
    slices = max(1, -(-sum(r["count"] for r in known) // slice_rows))
    found = []
    for i in range(slices):
        part = hashes.where(F.pmod(F.hash("h"), F.lit(slices)) == i)
        for r in known:
            mine = part.where(F.col("size") == r["size"]).select("h")
            found.append(_document_windows(docs, [r["size"]]).join(F.broadcast(mine), "h", "left_semi"))
    empty = windows.select(F.lit(None).cast(docs.schema["id"].dataType).alias("id"), F.lit(0).cast("long").alias("key"),
                           F.lit(0).alias("pos"), "size", "gram", "h", "item_id").where("false")
    if not found:
        return empty.select("id", "key", "pos", "size", "item_id")
    seen = reduce(DataFrame.unionByName, found)
    return seen.join(windows, ["h", "size", "gram"]).select("id", "key", "pos", "size", "item_id")


def _merge(spans: Column) -> Column:
    """Sorted (pos, end) structs merged to disjoint spans."""
    return F.aggregate(
        spans, F.array().cast("array<struct<pos:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["pos"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1),
                     F.array(F.struct(F.element_at(acc, -1)["pos"].alias("pos"),
                                      F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(F.struct(s["pos"].alias("pos"), s["end"].alias("end"))))))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", size: int = WINDOW,
                  share: int = SHARE) -> DataFrame:
    """One row for each document: id, key, n_words, n_hit, items (sorted as strings), spans of hit
    words (pos, end), contaminated."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    windows = keep(benchmark_windows(items, item_id, item_text, size), "decon-windows")
    found = hits(docs, windows)
    by_doc = keep(found.groupBy("id", "key").agg(
        F.array_sort(F.collect_set(F.struct("pos", (F.col("pos") + F.col("size")).alias("end")))).alias("places"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    ).select(F.col("id").alias("hit_id"), F.col("key").alias("hit_key"), "items", _merge(F.col("places")).alias("spans")), "decon-hits")
    base = docs.select("id", row_key(F.col("text")).alias("key"), word_count(F.col("text")).alias("n_words"))
    out = base.join(by_doc, F.expr("id <=> hit_id and key = hit_key"), "left")
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["pos"]), F.lit(0)).cast("long")
    return out.select(
        F.col("id").alias(id_col), "key", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<pos:int,end:int>>")).alias("spans"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the contaminated documents, all columns kept."""
    bad = (decontaminate(docs, items, id_col, text_col, **how).where("contaminated")
           .select(F.col(id_col).alias("bad_id"), F.col("key").alias("bad_key")).distinct())
    return docs.join(bad, F.col("bad_id").eqNullSafe(docs[id_col]) & (F.col("bad_key") == row_key(docs[text_col])), "left_anti")


def op7_decontaminate(spark, sf_dir):
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP7_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM bi),
di AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM bg) s WHERE len(w) >= k),
dg AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM di),
hit AS (SELECT dg.doc_id, dg.i, dg.k, bg.item_id FROM dg JOIN bg ON dg.g = bg.g AND dg.k = bg.k),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) t GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x COLLATE "C") AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) t GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""
