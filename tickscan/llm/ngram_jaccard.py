"""N-gram Jaccard join: documents whose sets of k-word shingles overlap by a threshold.

The join is the product of the sparse document-by-n-gram incidence with its transpose, cut down
before it is formed:

* rows: documents with equal shingle sets are one class, so copies are one row;
* columns: a pair at or above the threshold shares a column among the first n - ceil(t*n) + 1
  n-grams of either set, in any global order. The order puts n-grams that more than ``heavy``
  classes hold last, so a passage that many documents share makes no column, and then goes by
  hash. Counts for that order cover all classes;
* product, first block: each column links its members to its smallest member of the same size
  band. Pairs are verified on the whole texts and united;
* product, second block: columns that still hold members of different components; those with the same
  members are one. Up to ``heavy`` members, all pairs of them that sizes and positions allow are
  summed to overlap counts, pairs below the bound that follows from sizes and last common positions
  are discarded, and the rest is verified. Columns with more members, which only texts made of
  widespread passages have, are multiplied out in dense cells of bounded size: a cell's whole sets
  become a 0/1 matrix, its product with itself the overlaps, and only a spanning forest leaves it.

So no pair at or above the threshold is lost unless its two ends are linked already, and a group of
near copies costs as many pairs as it has members. No class list or component goes to the driver.

Defined cases: null or empty text, or text without words, has an empty set and no links; a row with
null id keeps its row, has no links and a null component; rows that repeat an id share its
component; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, drop, free_name, keep, parts, table
from .words import chunks, lists, mix, sets_by_row, shingles

K = 4
PERCENT = 85
#: An n-gram that more classes hold is ordered last.
HEAVY = 16
#: Members that one task compares with a pivot at once.
BLOCK = 256
#: Members and shingles of one cell of the dense product, about.
CELL_ROWS, CELL_SHINGLES = 1024, 500_000


def need(n: int, percent: int) -> int:
    """Length of the part of a sorted set that must meet that of any set similar enough."""
    return n - (percent * n + 99) // 100 + 1


def set_key(s: np.ndarray) -> int:
    """64-bit identity of a sorted set."""
    u = s.view(np.uint64)
    at = np.arange(1, len(u) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix(np.array([mix(u ^ at).sum(dtype=np.uint64) ^ np.uint64(len(u))], np.uint64)).view(np.int64)[0])


def _features(percent: int, k: int, whole: bool):
    def run(batches):
        for b in batches:
            for rows, w in chunks(b, "text", "space"):
                off, h = shingles(w, k)
                n, key, low = [], [], []
                for s in sets_by_row(off, h):
                    n.append(len(s))
                    key.append(set_key(s) if len(s) else 0)
                    low.append(s if whole else s[:need(len(s), percent) * 3 // 2 + 2])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.int64()), lists(low)],
                    ["id", "n", "cls", "low"])
    return run


def features(docs: DataFrame, percent: int, k: int, whole: bool = False) -> DataFrame:
    return docs.select("id", "text").mapInArrow(_features(percent, k, whole), "id long, n long, cls long, low array<long>")


def columns(reps: DataFrame, texts: DataFrame, percent: int, k: int, heavy: int) -> DataFrame:
    """(h, cls, n, pos): the columns of each class that the threshold makes it need. Deletes ``reps``
    (cls, rep, n, low), the widest table, once its sets are cut."""
    p = f"n - ({percent} * n + 99) div 100 + 1"
    held = reps.select("cls", F.explode("low").alias("h"))
    many = keep(held.groupBy("h").count().where(F.col("count") > heavy).select("h"), "ngram-heavy")
    mine = held.join(many, "h").groupBy("cls").agg(F.array_sort(F.collect_set("h")).alias("last"))
    split = (reps.join(mine, "cls", "left")
             .withColumn("last", F.coalesce("last", F.array().cast("array<long>")))
             .withColumn("first", F.array_except("low", "last")))
    known = F.expr(f"size(low) = n or size(first) >= {p}")
    split = keep(split.withColumn("known", known).select(
        "cls", "rep", "n", "known",
        F.when(known, F.expr(f"slice(concat(first, last), 1, cast({p} as int))")).alias("pre")), "ngram-prefix")
    drop(reps)
    # sets whose low end is mostly heavy: order the whole set
    short = keep(split.where("not known").select(F.col("rep").alias("id"), F.col("cls").alias("c")), "ngram-short")
    full = features(texts.join(short.select("id"), "id", "left_semi"), percent, k, whole=True).dropDuplicates(["cls"])
    full = full.join(short, F.expr("c = cls"), "left_semi")
    each = full.select("cls", "n", F.explode("low").alias("h")).join(many.withColumn("heavy", F.lit(1)), "h", "left")
    whole = (each.groupBy("cls", "n")
             .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("heavy", F.lit(0)).alias("w"), "h"))).alias("s"))
             .select("cls", "n", F.expr(f"slice(s.h, 1, cast({p} as int))").alias("pre")))
    pre = split.where("known").select("cls", "n", "pre").unionByName(whole)
    out = keep(pre.select("cls", "n", F.posexplode("pre").alias("pos", "h")), "ngram-columns")
    drop(split, short, many)
    return out


def _compare(percent: int, k: int):
    def run(batches):
        block, pivot, key = None, None, None
        for b in batches:
            a, z = [], []
            for rows, w in chunks(b, "text", "space"):
                cls, blk, member = (rows.column(c).to_pylist() for c in ("cls", "block", "member"))
                for i, s in enumerate(sets_by_row(*shingles(w, k))):
                    if set_key(s) != cls[i]:  # another text of a repeated id
                        continue
                    if not member[i]:
                        block, pivot, key = blk[i], s, cls[i]
                        continue
                    if blk[i] != block or key == cls[i]:
                        continue
                    both = len(np.intersect1d(pivot, s, assume_unique=True))
                    if 100 * both >= percent * (len(pivot) + len(s) - both):
                        a.append(key)
                        z.append(cls[i])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], ["a", "b"])
    return run


def verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """Those of ``pairs`` (a, b: classes) whose whole texts are similar enough. Pairs of one pivot
    are dealt out in blocks of about ``BLOCK`` members, so a pivot with many members is no hot task."""
    sizes = pairs.groupBy("a").count()
    blocks = pairs.join(sizes, "a").select(
        "a", "b", F.xxhash64("a", F.expr(f"pmod(xxhash64(b), 1 + count div {BLOCK})")).alias("block"))
    rows = (blocks.select("block", F.col("b").alias("cls"), F.lit(1).alias("member"))
            .union(blocks.select("block", F.col("a").alias("cls"), F.lit(0).alias("member")).distinct()))
    rows = rows.join(reps.select("cls", "rep"), "cls").select("block", "cls", "member", F.col("rep").alias("id"))
    n = parts(texts.sparkSession)
    dealt = (texts.join(rows, "id").select("block", "member", "cls", "text")
             .repartition(n, "block").sortWithinPartitions("block", "member"))
    return dealt.mapInArrow(_compare(percent, k), "a long, b long")


def jaccard_links(texts: DataFrame, cols: DataFrame, reps: DataFrame, percent: int, k: int, heavy: int) -> DataFrame:
    """(a, b): verified links between classes that make up all components; ``cols`` is deleted."""
    banded = cols.withColumn("band", F.expr(f"cast(floor(ln(n) / -ln({percent} / 100.0)) as int)"))
    pivot = banded.groupBy("h", "band").agg(F.min("cls").alias("a"))
    star = (banded.join(pivot, ["h", "band"]).where("a <> cls")
            .select("a", F.col("cls").alias("b")).distinct())
    star = keep(star, "ngram-star")
    first = keep(verified(star, reps, texts, percent, k), "ngram-links")
    drop(star)
    comp = keep(connected_components(first), "ngram-comp")
    named = (cols.join(comp.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("comp", F.coalesce("comp", "cls")))
    # columns of the same members are told by the sum of the members' hashes
    member = F.sum(F.xxhash64("cls").cast("decimal(38,0)"))
    mixed = named.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"),
                                   F.sum("n").alias("shingles"), member.alias("same")).where("lo < hi")
    mixed = mixed.select("h", "size", "shingles", F.xxhash64("same", "size").alias("group"))
    open_cols = keep(named.join(mixed, "h").groupBy("group", "size", "shingles", "cls", "n", "comp")
                     .agg(F.count("*").alias("w"), F.max("pos").alias("pos")), "ngram-open")
    drop(cols, comp)
    light, dense = open_cols.where(F.col("size") <= heavy), keep(open_cols.where(F.col("size") > heavy), "ngram-dense")
    x = light.select("group", "w", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("comp").alias("ca"))
    y = light.select("group", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("comp").alias("cb"))
    sizes = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
    # what stands up to the last common column, and what may follow
    places = f"(100 + {percent}) * (least(pa, pb) + 1 + least(na - pa - 1, nb - pb - 1)) >= {percent} * (na + nb)"
    product = (x.join(y, "group").where(f"a < b and ca <> cb and {sizes} and {places}")
               .groupBy("a", "b", "na", "nb").agg(F.sum("w").alias("overlap"), F.max("pa").alias("pa"), F.max("pb").alias("pb")))
    # the light columns give all overlap up to the last of them, but for heavy ones: those come last
    rest = product.where(f"(100 + {percent}) * (overlap + least(na - pa - 1, nb - pb - 1)) >= {percent} * (na + nb)")
    second = verified(keep(rest.select("a", "b"), "ngram-rest"), reps, texts, percent, k)
    out = keep(first.union(second).union(multiplied(dense, reps, texts, percent, k)), "ngram-links")
    drop(open_cols, dense, first)
    return out


def _forest(sets: list[np.ndarray], cls: list[int], comp: list[int], percent: int) -> list[tuple[int, int]]:
    """Pairs of ``cls`` that connect what the similarity of ``sets``, or a common ``comp``, connects."""
    m, n = len(sets), np.array([len(x) for x in sets])
    row = np.repeat(np.arange(m), n)
    _, col, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(held > 1) - 1
    use = held[col] > 1
    row, col = row[use], shared[col[use]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((m, m), np.float32)
    for a in range(0, int(shared[-1]) + 1, 2048):
        at = slice(*np.searchsorted(col, [a, a + 2048]))
        part = np.zeros((m, 2048), np.float32)
        part[row[at], col[at] - a] = 1
        both += part @ part.T
    comp = np.array(comp)
    link = (100 + percent) * both >= percent * (n[:, None] + n[None, :])
    link |= comp[:, None] == comp[None, :]
    label = np.arange(m)
    while True:
        new = np.array([label[link[i]].min() for i in range(m)])
        if (new == label).all():
            return [(cls[j], cls[i]) for i, j in enumerate(label) if i != j]
        label = new


def _multiply(percent: int, k: int):
    def run(batches):
        cell, held = None, ([], [], [])
        for b in batches:
            out = []
            for rows, w in chunks(b, "text", "space"):
                cells, cls, comp = (rows.column(c).to_pylist() for c in ("cell", "cls", "comp"))
                for i, s in enumerate(sets_by_row(*shingles(w, k))):
                    if set_key(s) != cls[i]:  # another text of a repeated id
                        continue
                    if cells[i] != cell:
                        if held[0]:
                            out += _forest(*held, percent)
                        cell, held = cells[i], ([], [], [])
                    for x, v in zip(held, (s, cls[i], comp[i])):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in (0, 1)], ["a", "b"])
        if held[0]:
            out = _forest(*held, percent)
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in (0, 1)], ["a", "b"])
    return run


def multiplied(dense: DataFrame, reps: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """(a, b): links among the members of each group of ``dense`` (group, size, shingles, cls, comp).
    A group's members are dealt to parts of bounded size, and each pair of parts is one cell."""
    cut = dense.withColumn("cuts", F.expr(f"1 + greatest(size div {CELL_ROWS}, shingles div {CELL_SHINGLES})"))
    cut = cut.withColumn("own", F.expr("pmod(xxhash64(cls), cuts)"))
    cut = cut.withColumn("other", F.explode(F.expr("sequence(0L, cuts - 1)")))
    cells = cut.select(F.xxhash64("group", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "cls", "comp")
    rows = keep(cells.distinct().join(reps.select("cls", F.col("rep").alias("id")), "cls"), "ngram-cells")
    dealt = (texts.join(rows, "id").select("cell", "cls", "comp", "text")
             .repartition(parts(texts.sparkSession), "cell").sortWithinPartitions("cell", "cls"))
    return dealt.mapInArrow(_multiply(percent, k), "a long, b long")


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                       percent: int = PERCENT, heavy: int = HEAVY) -> DataFrame:
    """(id, n_shingles, component_id, n_links): one row for each row of ``docs``.

    ``n_links`` counts the verified links of the row's class that were needed to build components
    (0: alone with its copies); ``component_id`` is the smallest id that links reach.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = keep(features(docs, percent, k), "ngram-features")
    some = rows.where("n > 0 and id is not null")
    reps = keep(some.groupBy("cls").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("low").alias("low")), "ngram-classes")
    members = keep(rows.select("id", "n", "cls"), "ngram-rows")
    drop(rows)
    # an id may stand on several rows with different texts: such a class needs the text of its own
    texts = docs.where("id is not null and text is not null")
    small = keep(reps.select("cls", "rep"), "ngram-members")
    links = jaccard_links(texts, columns(reps, texts, percent, k, heavy), small, percent, k, heavy)
    comp = connected_components(links).withColumnRenamed("node", "cls")
    degree = links.select(F.col("a").alias("cls")).union(links.select("b")).groupBy("cls").agg(F.count("*").alias("n_links"))
    named = small.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    known = (named.join(least, "comp").select("cls", "component_id")
             .join(degree, "cls", "left"))
    out = members.join(known, "cls", "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component_id"))).otherwise(F.col("id")).alias("component_id"),
        F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"))
    return out.withColumnRenamed("id", id_col)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, repeated rows once. Rows
    without words or without an id are never joined with others, so they all stay."""
    first = (ngram_jaccard_join(docs, id_col, text_col, **how).where(F.col(id_col) == F.col("component_id"))
             .select(F.col(id_col).cast("long").alias("_first")).distinct())
    mark = free_name(docs, "text_key")
    alone = docs.where(F.col(id_col).isNull())
    kept = docs.join(first, docs[id_col].cast("long") == F.col("_first"), "left_semi").withColumn(mark, F.xxhash64(text_col))
    return kept.dropDuplicates([id_col, mark]).drop(mark).unionByName(alone)


def op5_ngram_jaccard_join(spark, sf_dir):
    """One row per document: doc_id, n_shingles, component_id (4-word shingles, 85 %)."""
    return ngram_jaccard_join(table(spark, sf_dir, "documents")).drop("n_links")


OP5_SQL = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM dw WHERE len(w) > 0) t),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM documents d JOIN reach ON reach.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
