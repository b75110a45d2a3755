"""Merkle manifest of a dataset: a digest of each row, a tree over each group's rows, one over the
groups, and for every row the siblings that lead from its leaf to the root.

Method: sibling-shift self-joins. A level is a table of nodes (tree, pos, n, digest). Each node
equijoins the nodes at its siblings' computed indices (``pos XOR 1`` for two to a run, the other
slots of the run otherwise); then the rows of slot zero emit the parents, the next level's nodes.
Proofs go down the same way: a node's own siblings, then the proof of the parent at ``pos // arity``.
No task sees more than its share of a level, whatever a group's size. Positions come from a range
partitioned sort by (group, order, arrival), so a group, an id or a row that holds any part of the
table is spread too; only partition counts are summed up.

``H`` is the lowercase hex sha256 of its inputs joined, digests as hex text. A leaf is H of the
chosen columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value (integers
decimal). While a tree has more than one node, every ``arity`` consecutive ones (the last run:
fewer, even one) become their H. The roots of the groups, in the order of the groups (null first,
then by UTF-8 bytes), are the leaves of the last tree in the same way. A lone leaf is its own root.

Defined cases: null and empty values differ by the rule above; null groups form a group of their
own; leaves ascend by id, null ids first, rows that repeat an id by their digests, so that equal
rows take neighbouring places (which of them which, does not show); empty tables give no rows;
extra columns are ignored. Texts are read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, keep, parts, table

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
#: Nodes that one file of a written level holds, about.
ROWS_PER_FILE = 500_000
#: Levels of proofs between two written tables.
WRITE_EVERY = 4
EMPTY = "X''"


def H(*hexes: Column) -> Column:
    return F.sha2(F.concat(*hexes), 256)


def leaf(*columns: Column) -> Column:
    """The digest of a row's values."""
    def told(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return H(*[told(c) for c in columns])


def ranked(rows: DataFrame, group: str | None, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with pos (from 0 in the order of ``order`` inside the group) and n (rows of the
    group), and the written table that it reads.

    One range partitioned sort; the arrival number as last key spreads rows that are equal."""
    keys = ([group] if group else []) + order
    r = rows.withColumn("_arrival", F.monotonically_increasing_id())
    r = r.repartitionByRange(parts(rows.sparkSession), *keys, "_arrival").sortWithinPartitions(*keys, "_arrival")
    kept = keep(r.drop("_arrival").withColumn("_at", F.monotonically_increasing_id()), "merkle-ranked")
    r = kept.withColumn("_part", F.shiftright("_at", 33))
    by = ["_part"] + ([group] if group else [])
    c = r.groupBy(*by).agg(F.min("_at").alias("_low"), F.count("*").alias("_n"))  # groups + partitions rows at most
    whole = Window.partitionBy(*([group] if group else [F.lit(0)]))
    c = c.select(F.col("_part").alias("_p"), *([F.col(group).alias("_g")] if group else []), "_low",
                 (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(whole).alias("n"))
    same = F.col("_part") == F.col("_p")
    if group:
        same &= F.col(group).eqNullSafe(F.col("_g"))
    out = r.join(c, same).withColumn("pos", F.col("_before") + F.col("_at") - F.col("_low"))
    return out.select(*rows.columns, "pos", "n"), kept


def _sibling(arity: int, d: int) -> Column:
    if arity == 2:
        return F.col("pos").bitwiseXOR(F.lit(1))
    slot = F.col("pos") % arity
    return F.col("pos") - slot + (slot + d) % arity


def grow(nodes: DataFrame, most: int, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """Levels of the trees over ``nodes`` (tree, pos, n, digest and more columns at the leaves) as
    written tables with ``others`` (the siblings' digests, left to right, as bytes), and (tree, root);
    ``most``: leaves of the largest tree."""
    levels, roots = [], []
    size = 0
    while True:
        base = nodes if not levels else nodes.where("n > 1")
        met = base
        for d in range(1, arity):
            other = nodes.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("digest").alias(f"_s{d}"))
            met = met.join(other, (F.col("tree") == F.col("_tree")) & (_sibling(arity, d) == F.col("_pos")), "left").drop("_tree", "_pos")
        # slot d further on, round the run: those that come round stand left of the node
        turn = [F.struct(((F.col("pos") % arity + d) % arity).alias("slot"), F.col(f"_s{d}").alias("h")) for d in range(1, arity)]
        others = F.aggregate(F.array_sort(F.array(*turn)), F.expr(EMPTY), lambda a, s: F.concat(a, F.coalesce(F.unhex(s["h"]), F.expr(EMPTY))))
        met = met.withColumn("others", others).drop(*[f"_s{d}" for d in range(1, arity)])
        if levels:
            met = met.coalesce(max(1, min(parts(nodes.sparkSession), -(-size // ROWS_PER_FILE))))
        level = keep(met, "merkle-level")
        levels.append(level)
        size = level.count() // arity + 1
        if len(levels) == 1:
            roots.append(level.where("n = 1").select("tree", F.col("digest").alias("root")))
        if most <= 1:
            break
        most = -(-most // arity)
        nodes = level.where((F.col("n") > 1) & (F.col("pos") % arity == 0)).select(
            "tree", F.expr(f"pos div {arity}").alias("pos"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            H(F.col("digest"), F.lower(F.hex("others"))).alias("digest"))
        roots.append(nodes.where("n = 1").select("tree", F.col("digest").alias("root")))
        if most == 1:  # only roots are left
            break
    out = roots[0]
    for r in roots[1:]:
        out = out.union(r)
    return levels, keep(out.coalesce(parts(out.sparkSession)), "merkle-roots")


def prove(levels: list[DataFrame], arity: int = ARITY) -> DataFrame:
    """The leaves with ``proof``: the siblings of each level up to the root, as bytes."""
    written = []
    down = None
    for k in reversed(range(len(levels))):
        here = levels[k]
        if down is None:
            down = here.withColumnRenamed("others", "proof")
        else:
            up = down.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("proof").alias("_proof"))
            down = (here.join(up, (F.col("tree") == F.col("_tree")) & (F.expr(f"pos div {arity}") == F.col("_pos")), "left")
                    .withColumn("proof", F.concat("others", F.coalesce("_proof", F.expr(EMPTY)))).drop("_tree", "_pos", "_proof", "others"))
        if k and (len(levels) - k) % WRITE_EVERY == 0:
            down = keep(down, "merkle-proofs")
            written.append(down)
            drop(*levels[k:k + WRITE_EVERY], *written[:-1][-1:])
    return down


def fold(digest: Column, proof: Column, pos: Column, n: Column, levels: int, arity: int = ARITY) -> Column:
    """The root that ``digest`` and the siblings in ``proof`` (hex text) lead to."""
    start = F.struct(digest.alias("h"), pos.cast("long").alias("pos"), n.cast("long").alias("n"), F.lit(1).alias("at"))

    def up(a: Column, _: Column) -> Column:
        slot = (a["pos"] % arity).cast("int")
        run = F.least(F.lit(arity), a["n"] - a["pos"] + slot).cast("int")
        left = F.substring(proof, a["at"], slot * 64)
        right = F.substring(proof, a["at"] + slot * 64, (run - 1 - slot) * 64)
        next_ = F.struct(H(left, a["h"], right).alias("h"), F.call_function("div", a["pos"], F.lit(arity)).alias("pos"),
                         F.call_function("div", a["n"] + (arity - 1), F.lit(arity)).alias("n"), (a["at"] + (run - 1) * 64).alias("at"))
        return F.when(a["n"] > 1, next_).otherwise(a)

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(levels, 1))), start, up, lambda a: a["h"])


def manifest(rows: DataFrame, group: str, id_col: str, digest: str, arity: int = ARITY) -> DataFrame:
    """``rows`` (with a leaf's digest as hex text in each) with pos and n inside the group, tree (the
    group's place), n_groups, subroot, root, and the proofs (hex text) in_group and in_root."""
    held = list(rows.columns)
    r, sorted_rows = ranked(rows, group, [id_col, digest])
    groups, sorted_groups = ranked(r.groupBy(F.col(group).alias("_of")).agg(F.count("*").alias("_size")), None, ["_of"])
    groups = keep(groups.withColumnsRenamed({"pos": "tree", "n": "n_groups"}), "merkle-groups")
    most, n_groups = groups.agg(F.max("_size"), F.count("*")).first()
    r = r.join(groups.select("_of", "tree"), F.col(group).eqNullSafe(F.col("_of"))).drop("_of")
    levels, subroots = grow(r.withColumnRenamed(digest, "digest"), most or 1, arity)
    drop(sorted_rows, sorted_groups)
    top = groups.select("tree", "n_groups").join(subroots.withColumnRenamed("root", "subroot"), "tree")
    tops, roots = grow(top.select(F.lit(0).alias("tree"), F.col("tree").alias("pos"), F.col("n_groups").alias("n"),
                                  F.col("subroot").alias("digest")), max(n_groups, 1), arity)
    root = roots.first()  # one row
    top = keep(prove(tops, arity).select(F.col("pos").alias("_tree"), F.col("digest").alias("subroot"),
                                         F.lower(F.hex("proof")).alias("in_root"), F.col("n").alias("n_groups")), "merkle-top")
    out = prove(levels, arity).withColumn("in_group", F.lower(F.hex("proof"))).withColumnRenamed("digest", digest)
    out = out.join(top, F.col("tree") == F.col("_tree")).withColumn("root", F.lit(root["root"] if root else None).cast("string"))
    out = out.select(*held, "pos", "n", "tree", "n_groups", "subroot", "root", "in_group", "in_root")
    out._levels = (len(levels), len(tops))
    return out


def folded(m: DataFrame, digest: str, arity: int = ARITY) -> Column:
    """The root of the whole recomputed from the column ``digest`` and the proofs of ``manifest``."""
    inner, outer = m._levels
    sub = fold(F.col(digest), F.col("in_group"), F.col("pos"), F.col("n"), inner, arity)
    return fold(sub, F.col("in_root"), F.col("tree"), F.col("n_groups"), outer, arity)


def op12_merkle_manifest(spark, sf_dir):
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    docs = table(spark, sf_dir, "documents")
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    changed = F.when(hit, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    rows = docs.select("doc_id", "lang", leaf(*[F.col(c) for c in COLUMNS]).alias("leaf"),
                       leaf(*[changed if c == "n_chars" else F.col(c) for c in COLUMNS]).alias("tampered"))
    leaves = keep(rows, "merkle-leaves")  # texts are read once
    m = manifest(leaves, "lang", "doc_id", "leaf")
    drop(leaves)
    return m.select("doc_id", "leaf", "subroot", "root", H(F.col("in_group"), F.col("in_root")).alias("proof_sha256"),
                    folded(m, "tampered").alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _told(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR) END"


def _levels_sql(name: str, nodes: str) -> str:
    """All nodes of the trees over ``nodes`` (tree, pos, n, h), by level."""
    return f"""{name} AS (
  SELECT tree, 0 AS lvl, pos, n, h FROM {nodes}
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY tree, lvl, n, pos // 2)"""


def _fold_sql(name: str, start: str, levels: str) -> str:
    """Digests of ``start`` (r, tree, pos, n, h) carried up with the siblings in ``levels``."""
    return f"""{name} AS (
  SELECT r, tree, 0 AS lvl, pos, n, h FROM ({start})
  UNION ALL
  SELECT f.r, f.tree, f.lvl + 1, f.pos // 2, (f.n + 1) // 2,
         sha256(CASE WHEN f.pos % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END)
  FROM {name} f LEFT JOIN {levels} s ON s.tree = f.tree AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1) WHERE f.n > 1)"""


_CRC32 = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

OP12_SQL = f"""
WITH RECURSIVE lf AS (
  SELECT *, sha256({" || ".join(map(_told, COLUMNS))}) AS h, {_CRC32} % 7 = 0 AS hit FROM documents),
lt AS (SELECT *, CASE WHEN hit THEN sha256({" || ".join(_told("(n_chars + 1)" if c == "n_chars" else c) for c in COLUMNS)}) ELSE h END AS t FROM lf),
d AS (SELECT row_number() OVER () AS r, doc_id, h, t, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM lt),
{_levels_sql("lv", "d")},
sub AS (SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, h FROM lv WHERE n = 1),
{_levels_sql("tv", "sub")},
p1 AS (SELECT r, string_agg(s.h, '' ORDER BY s.lvl) AS p FROM d JOIN lv s ON s.tree = d.tree AND s.n > 1 AND s.pos = xor(d.pos >> s.lvl, 1) GROUP BY r),
p2 AS (SELECT sub.pos AS tree, string_agg(s.h, '' ORDER BY s.lvl) AS p FROM sub JOIN tv s ON s.n > 1 AND s.pos = xor(sub.pos >> s.lvl, 1) GROUP BY sub.pos),
{_fold_sql("f1", "SELECT r, tree, pos, n, t AS h FROM d", "lv")},
{_fold_sql("f2", "SELECT f1.r, 0 AS tree, f1.tree AS pos, sub.n, f1.h FROM f1 JOIN sub ON sub.pos = f1.tree WHERE f1.n = 1", "tv")}
SELECT d.doc_id, d.h AS leaf, sub.h AS subroot, tv.h AS root, sha256(coalesce(p1.p, '') || coalesce(p2.p, '')) AS proof_sha256,
       f2.h AS folded_root, f2.h = tv.h AS verified
FROM d JOIN sub ON sub.pos = d.tree JOIN tv ON tv.n = 1 JOIN f2 ON f2.r = d.r AND f2.n = 1
LEFT JOIN p1 ON p1.r = d.r LEFT JOIN p2 ON p2.tree = d.tree
"""
