"""Small helpers shared by the operators: input tables, written intermediate tables, components."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import prepare, scratch_path

__all__ = ["table", "keep", "drop", "parts", "free_name", "with_field", "connected_components", "prepare"]


#: Rows that a Python task gets at once: bounds its memory when texts are long.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read with Spark's reader only (the path may be in any store Spark knows)."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder in spark.checkpoint.dir and read it again: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._kept_at = path
    release(df.sparkSession)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now, not when the driver next happens to
    collect its garbage; between steps that each move the corpus this halves the disk in use."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``keep`` wrote and that nothing reads any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._kept_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores after it, so that no column of ``df`` has it (in any case)."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def with_field(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """The schema of ``df`` and one more column."""
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``edges`` (a, b: long); comp is the smallest node reachable.

    Alternates large-star and small-star steps (each neighbour of a node, or each smaller one, is
    linked to the smallest of them) until nothing changes; rows stay at most the edge count, all
    work is joins and partial minima, and every round is written to the shared folder.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    e = keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc")
    state = None
    while True:
        near = both(e)
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        low2 = large.groupBy(F.col("b").alias("k")).agg(F.min("a").alias("m"))
        small = large.join(low2, large.b == low2.k)
        out = (small.select(F.col("m").alias("a"), "b")
               .union(small.select(F.col("m").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
        old, e = e, keep(out, "cc")
        drop(old)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                    F.count(F.when(F.col("a") > F.col("b"), 1))).first()
        if state == now:
            break
        state = now
    return e.select(F.col("b").alias("node"), F.col("a").alias("comp")).union(
        e.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct())
