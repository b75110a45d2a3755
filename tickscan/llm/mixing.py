"""Mixing sources to target weights by Poisson replication.

Each source gets a target weight; its rate is the mean number of times one of its documents must be
repeated for the source to reach its share of the mix. The number of copies of a document is the
inverse Poisson distribution with that mean at a uniform number that the document's id and the seed
hash to: no state, the same on every run and for every partitioning. Documents are exploded by their
number of copies and put in the order of a second hash, range partitioned and sorted: a global
shuffle without hot partitions, whatever the sources' sizes.

Without given weights a source of n documents weighs n ** ``ALPHA``; the mix then has as many
documents as the input, on average. Counts cover all documents; the rates (one row for each source)
are joined, never collected.

Defined cases: null source is a source of its own; a row with null id draws by its columns and its number
among the rows equal to it, so that such rows draw each for itself, wherever they stand in the input; rows that
repeat an id get equal numbers of copies; a source that given weights leave out gets no copies;
null or empty texts are documents like others; empty tables give no rows; extra columns are kept,
and the added columns get underscores where names clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, keep, parts, table

ALPHA = 0.5
SEED = 17
#: The distribution is tabulated to so many standard deviations above the mean, and 40 more.
DEVIATIONS = 12


def uniform(*key: Column) -> Column:
    """52 bits of md5 as an integer."""
    text = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in key])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def rates(docs: DataFrame, source: str = "source", weights: DataFrame | None = None, alpha: float = ALPHA) -> DataFrame:
    """(source, rate, cdf): the mean copies of each source's documents, and the distribution."""
    n = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        n = n.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(alpha)))
    else:
        w = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double").alias("weight"))
        n = n.join(w, F.expr("source <=> w_source"), "left").withColumn("weight", F.coalesce("weight", F.lit(0.0))).drop("w_source")
    all_n, all_weight = n.agg(F.sum("n"), F.sum("weight")).first()
    r = n.select("source", (F.col("weight") * F.lit(all_n) / F.lit(all_weight) / F.col("n")).alias("rate")).where("rate > 0")
    k = r.select("source", "rate", F.explode(F.expr(f"sequence(0, cast(rate + {DEVIATIONS} * sqrt(rate) + 40 as int))")).alias("k"))
    upto = Window.partitionBy("source").orderBy("k")
    p = k.withColumn("lp", F.expr("k * ln(rate) - rate") - F.sum(F.when(F.col("k") > 0, F.ln("k")).otherwise(0.0)).over(upto))
    cdf = p.withColumn("cdf", F.sum(F.exp("lp")).over(upto))
    return cdf.groupBy("source").agg(F.first("rate").alias("rate"), F.array_sort(F.collect_list("cdf")).alias("cdf"))


def keyed(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with _mix_key, by which a row draws. Rows without id are counted with their equals and
    numbered; equal rows meet as one row and a count."""
    every = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    named = docs.where(docs[id_col].isNotNull()).withColumn("_mix_key", docs[id_col].cast("string"))
    loose = docs.where(docs[id_col].isNull()).groupBy(*every).agg(F.count("*").alias("_mix_n"))
    at = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_n"))).alias("_mix_at")
    body = F.md5(F.to_json(F.struct(*every)))
    loose = loose.select(*every, at).select(*every, F.concat(body, F.lit("#"), F.col("_mix_at").cast("string")).alias("_mix_key"))
    return named.union(loose)


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", weights: DataFrame | None = None,
        alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``docs`` repeated to the weights and shuffled, with copy (from 1), n_copies and shuffle_key."""
    name = {c: free_name(docs, c) for c in ("copy", "n_copies", "shuffle_key")}
    # written first: its size is then known, and Spark broadcasts it while it is small
    r = keep(rates(docs, source, weights, alpha), "mix-rates").select(F.col("source").alias("_mix_source"), F.col("cdf").alias("_mix_cdf"))
    drawn = keyed(docs, id_col)
    u = uniform(F.lit(seed), F.col("_mix_key")) / F.lit(float(1 << 52))
    drawn = drawn.withColumn("_mix_u", u).join(r, F.col(source).eqNullSafe(F.col("_mix_source")))
    drawn = drawn.withColumn(name["n_copies"], F.expr("size(filter(_mix_cdf, c -> _mix_u >= c))")).drop("_mix_cdf", "_mix_u", "_mix_source")
    every = drawn.where(F.col(name["n_copies"]) > 0).withColumn(name["copy"], F.explode(F.sequence(F.lit(1), F.col(name["n_copies"]))))
    every = every.withColumn(name["shuffle_key"], uniform(F.lit(seed + 1), F.col("_mix_key"), F.col(name["copy"])))
    return (every.repartitionByRange(parts(docs.sparkSession), name["shuffle_key"])
            .sortWithinPartitions(name["shuffle_key"], id_col, name["copy"]).drop("_mix_key"))


def op9_mix_sources(spark, sf_dir):
    """The mixed documents: all columns of documents, copy, n_copies, shuffle_key."""
    return mix(table(spark, sf_dir, "documents"))


def mix_sql(docs: str = "documents") -> str:
    """The rows of ``op9_mix_sources`` over the relation ``docs``."""
    return f"""
WITH n AS (SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM {docs} GROUP BY source),
r AS (SELECT source, weight * (SELECT sum(n) FROM n) / (SELECT sum(weight) FROM n) / n AS rate FROM n),
k AS (SELECT source, rate, unnest(range(0, CAST(floor(rate + {DEVIATIONS} * sqrt(rate) + 40) AS BIGINT) + 1)) AS k FROM r),
p AS (SELECT source, k, k * ln(rate) - rate - sum(CASE WHEN k > 0 THEN ln(k) ELSE 0.0 END) OVER (PARTITION BY source ORDER BY k) AS lp FROM k),
c AS (SELECT source, k, sum(exp(lp)) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
u AS (SELECT *, CAST(('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u FROM {docs}),
d AS (SELECT u.*, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND u.u >= c.cdf) AS n_copies FROM u),
e AS (SELECT * EXCLUDE (u), unnest(range(1, n_copies + 1)) AS copy FROM d WHERE n_copies > 0)
SELECT * EXCLUDE (copy, n_copies), CAST(copy AS INTEGER) AS copy, CAST(n_copies AS INTEGER) AS n_copies,
       CAST(('0x' || substr(md5('{SEED + 1}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(copy AS VARCHAR)), 1, 13)) AS BIGINT) AS shuffle_key
FROM e
"""


OP9_SQL = mix_sql()
