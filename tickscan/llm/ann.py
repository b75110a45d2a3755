"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``TABLES`` tables hashes a vector with ``HASHES`` Gaussian projections, shifted and cut into
cells whose width is ``WIDTH`` times the distance of the k-th neighbour, as measured (the median over
``SAMPLE`` index vectors of smallest hash, each compared with all rows). A query visits, in every table, its own bucket and those whose cells differ
by one where its projections lie nearest to a border: perturbations are taken from a heap in the order
of their summed squared distances to the borders, which is the order of estimated success. Inside a
visited bucket exact distances are computed with numpy in double precision and the ``k`` nearest are
kept; the finds of all tables are merged and reranked.

Equal vectors are one index row that carries its ``k + 1`` smallest ids (more can never be among the
k nearest), so a vector that a third of all rows share is no hot bucket. Buckets are dealt out in
blocks of about ``BLOCK`` rows, and queries go to all blocks of the buckets they visit: no cap, and no
task holds more than a block. Every row is indexed; the width alone is fitted, so that vectors of any
length are cut alike, and the projections come from a seed. Queries for which the buckets gave fewer than k
finds are compared with all rows, ``CHUNK`` of them at a time: no result is shorter than it must be.

Defined cases: vectors that are null, empty, zero, of another length than the most common one, or that
hold null or non-finite components take no part, nor do rows with null id; rows that repeat an id with
another vector are candidates of their own, the id is listed once with its smallest distance; with
fewer candidates than k all found are listed; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, keep, parts, table

K = 10
TABLES = 16
HASHES = 4
#: Of the median distance of the k-th neighbour.
WIDTH = 0.9
SAMPLE = 64
#: Queries that one scan of all rows answers.
CHUNK = 2048
PROBES = 40
SEED = 5
BLOCK = 4096


def perturbations(x: np.ndarray, most: int) -> list[tuple[tuple[int, int], ...]]:
    """Sets of (projection, -1 or 1), in order of estimated success; ``x``: places inside the cells."""
    steps = sorted([(v * v, i, -1) for i, v in enumerate(x)] + [((1 - v) ** 2, i, 1) for i, v in enumerate(x)])
    out: list[tuple[tuple[int, int], ...]] = [()]
    heap = [(steps[0][0], (0,))]
    while heap and len(out) < most:
        cost, at = heapq.heappop(heap)
        if len({steps[j][1] for j in at}) == len(at):
            out.append(tuple(steps[j][1:] for j in at))
        last = at[-1]
        if last + 1 < len(steps):
            heapq.heappush(heap, (cost - steps[last][0] + steps[last + 1][0], at[:-1] + (last + 1,)))
            heapq.heappush(heap, (cost + steps[last + 1][0], at + (last + 1,)))
    return out


def _bucket(cells: np.ndarray, t: int) -> np.ndarray:
    h = np.full(len(cells), t + 1, np.int64)
    for j in range(cells.shape[1]):
        h = (h * np.int64(6364136223846793005) + cells[:, j]) ^ (h >> np.int64(29))
    return h


def _keys(dim: int, probes: int, tables: int, hashes: int, width: float, seed: int):
    """One row for each vector, table and visited bucket."""
    def go(batches):
        rng = np.random.default_rng(seed)
        planes = rng.standard_normal((tables, dim, hashes))
        shift = rng.random((tables, hashes)) * width
        for b in batches:
            if not len(b):
                continue
            m = b.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(len(b), dim).astype(np.float64)
            of, key = [], []
            for t in range(tables):
                f = (m @ planes[t] + shift[t]) / width
                cell = np.floor(f).astype(np.int64)
                if probes == 1:
                    of.append(np.arange(len(b)))
                    key.append(_bucket(cell, t))
                    continue
                for i in range(len(b)):
                    sets = perturbations(f[i] - cell[i], probes)
                    cells = np.repeat(cell[i][None], len(sets), 0)
                    for r, s in enumerate(sets):
                        for j, step in s:
                            cells[r, j] += step
                    of.append(np.full(len(sets), i))
                    key.append(_bucket(cells, t))
            of = pa.array(np.concatenate(of))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(key)), *[c.take(of) for c in b.columns]], ["bucket", *b.schema.names])
    return go


def _nearest(dim: int, k: int):
    """Reads rows sorted by block, index rows before queries; gives each query's k nearest of the block."""
    def go(batches):
        block, ids, vecs = None, [], []
        held = None
        for b in batches:
            key, query = b.column("block").to_numpy(), b.column("query").to_numpy(zero_copy_only=False)
            m = b.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(len(b), dim).astype(np.float64)
            own = b.column("ids").to_pylist()
            out_q, out_v, out_d = [], [], []
            edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (query[1:] != query[:-1]), True]) if len(b) else [0]
            for a, z in zip(edge[:-1], edge[1:]):
                if key[a] != block:
                    block, ids, vecs, held = key[a], [], [], None
                if not query[a]:
                    ids += own[a:z]
                    vecs.append(m[a:z])
                    held = None
                    continue
                if not ids:
                    continue
                if held is None:
                    held = np.concatenate(vecs)
                for i in range(a, z):
                    d = np.sqrt(((held - m[i]) ** 2).sum(1))
                    near = np.argpartition(d, k)[:k + 1] if len(d) > k + 1 else np.arange(len(d))
                    near = np.flatnonzero(d <= d[near].max())  # ties too
                    pairs = sorted((d[j], v) for j in near for v in ids[j] if v != own[i][0])[:k]
                    out_q += [own[i][0]] * len(pairs)
                    out_v += [v for _, v in pairs]
                    out_d += [float(x) for x, _ in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_d, pa.float64())],
                                             ["query_id", "vec_id", "score"])
    return go


def vectors(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, vec) of the rows that take part, and the dimension."""
    v = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    if dict(v.dtypes)["vec"] not in ("array<float>", "array<double>"):
        v = v.withColumn("vec", F.col("vec").cast("array<double>"))
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    v = v.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).where(whole)
    top = v.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = top["dim"] if top else 0
    return v.where(F.size("vec") == dim), dim


def _scanned(queries, dim: int, k: int):
    """Each query's k + 1 nearest rows of a task, copies listed; ``queries``: (ids, vectors)."""
    def go(batches):
        own, q = queries.value
        best: list[list[tuple[float, int]]] = [[] for _ in own]
        for b in batches:
            if not len(b):
                continue
            m = b.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(len(b), dim).astype(np.float64)
            ids = b.column("ids").to_pylist()
            for i in range(len(own)):
                d = np.sqrt(((m - q[i]) ** 2).sum(1))
                least = best[i][-1][0] if len(best[i]) > k else np.inf
                near = np.flatnonzero(d <= least)
                if len(near) > k + 1:
                    near = near[d[near] <= np.partition(d[near], k)[k]]
                if len(near):
                    best[i] = sorted(best[i] + [(float(d[j]), v) for j in near for v in ids[j]])[:k + 1]
        rows = [(i, v, d) for i, x in zip(own, best) for d, v in x if v != i]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.float64()))],
                                         ["query_id", "vec_id", "score"])
    return go


def scanned(index: DataFrame, ids: np.ndarray, vecs: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score): candidates for the k nearest of some queries, from all rows of ``index``
    (vec, ids); what is broadcast are at most ``CHUNK`` vectors."""
    held = index.sparkSession.sparkContext.broadcast((ids.tolist(), vecs))
    return index.select("vec", "ids").mapInArrow(_scanned(held, vecs.shape[1], k), "query_id long, vec_id long, score double")


def cell_width(index: DataFrame, k: int, share: float = WIDTH) -> float:
    """``share`` of the median distance from ``SAMPLE`` rows of ``index`` to their k-th neighbour."""
    some = index.orderBy(F.xxhash64("ids"), F.xxhash64("vec")).limit(SAMPLE).select("vec", "ids").collect()
    ids, vecs = np.arange(-len(some), 0), np.array([r["vec"] for r in some], np.float64)
    near = scanned(index, ids, vecs, k + 1).groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list("score")), 1, k + 1).alias("d"))
    kth = [x for r in near.collect() if (x := r["d"][-1]) > 0]  # its own place is the first
    return share * float(np.median(kth)) if kth else 1.0


def search(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           tables: int = TABLES, hashes: int = HASHES, width: float | None = None, probes: int = PROBES, seed: int = SEED,
           block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k nearest rows found in ``df``,
    without the query's own id. ``width`` is measured if not given."""
    v, dim = vectors(df, id_col, vec_col)
    q, q_dim = vectors(queries, id_col, vec_col)
    if not dim or dim != q_dim:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    few = v.groupBy("vec", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt")).agg(F.array_sort(F.collect_set("id")).alias("ids"))
    few = few.select("vec", F.slice("ids", 1, k + 1).alias("ids"))
    index = keep(few.groupBy("vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")), "ann-vectors")
    width = cell_width(index, k) if width is None else width
    shape = f"bucket long, vec {dict(v.dtypes)['vec']}, ids array<long>"
    rows = keep(index.select("vec", "ids").mapInArrow(_keys(dim, 1, tables, hashes, width, seed), shape), "ann-index")
    asked = keep(q.dropDuplicates(["id", "vec"]).select("vec", F.array("id").alias("ids"))
                 .mapInArrow(_keys(dim, probes, tables, hashes, width, seed), shape), "ann-queries")
    sizes = rows.groupBy("bucket").count().select("bucket", F.expr(f"1 + count div {block}").alias("blocks"))
    dealt = rows.join(sizes, "bucket").select(
        F.xxhash64("bucket", F.expr("pmod(xxhash64(ids), blocks)")).alias("block"), F.lit(0).alias("query"), "ids", "vec")
    sent = asked.join(sizes, "bucket").select("bucket", "ids", "vec", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("at")).select(
        F.xxhash64("bucket", "at").alias("block"), F.lit(1).alias("query"), "ids", "vec")
    both = dealt.union(sent).repartition(parts(df.sparkSession), "block").sortWithinPartitions("block", "query")
    near = both.mapInArrow(_nearest(dim, k), "query_id long, vec_id long, score double")
    best = keep(near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), "ann-candidates")
    # queries with too few finds, one vector for each (id, vector), in chunks
    found = best.groupBy(F.col("query_id").alias("id")).count().where(F.col("count") >= k).select("id")
    rest = keep(q.dropDuplicates(["id", "vec"]).join(found, "id", "left_anti").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(1 << 20))), "ann-rest")
    short, parts_of = rest.count(), []
    chunks_of = max(1, -(-2 * short // CHUNK))
    for c in range(chunks_of if short else 0):
        mine = rest.where(F.col("part") % chunks_of == c).select("id", "vec").toArrow()
        if len(mine):
            vecs = mine.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(mine), dim).astype(np.float64)
            parts_of.append(keep(scanned(index, mine.column("id").to_numpy(), vecs, k), "ann-scanned"))
    held = best
    for p in parts_of:
        held = held.union(p)
    best = held.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")) if parts_of else best
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    out = keep(best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "ann-found")
    drop(rows, asked, index, rest, *parts_of)
    return out


def op8_multiprobe_ann(spark, sf_dir):
    """The 10 nearest rows found for every row whose vec_id is divisible by 100: query_id, rank, vec_id, score."""
    e = table(spark, sf_dir, "embeddings")
    return search(e, e.where("vec_id % 100 = 0"))
