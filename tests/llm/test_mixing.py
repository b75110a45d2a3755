"""Poisson replication: its SQL, weights, odd rows."""
import duckdb
from llm_support import SF
from pyspark.sql import functions as F

from tickscan.llm.mixing import mix, rates
from tickscan.llm.registry import ORACLES, QUERIES


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = QUERIES["op9_mix_sources"](spark, SF)
    rel = con.sql(ORACLES["op9_mix_sources"])
    at = [rel.columns.index(c) for c in df.columns]
    assert sorted(tuple(r) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in rel.fetchall())


def test_rates_and_weights(spark):
    docs = spark.createDataFrame([(i, "t", "big" if i % 3 else ("small" if i % 2 else None)) for i in range(3000)], "doc_id long, text string, source string")
    w = spark.createDataFrame([("big", 1.0), ("small", 1.0)], "source string, weight double")
    got = {r["source"]: r["rate"] for r in rates(docs, "source", w).collect()}
    assert abs(got["big"] - 0.75) < 1e-9 and abs(got["small"] - 3.0) < 1e-9 and None not in got
    out = mix(docs, weights=w).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in out}
    assert abs(n["big"] - 1500) < 150 and abs(n["small"] - 1500) < 150 and None not in n
    free = {r["source"] for r in mix(docs).select("source").distinct().collect()}
    assert None in free


def test_order_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a", 1), (1, None, "a", 1), (None, "", None, 2), (2, "x", "b", 3)] * 20,
                                 "doc_id long, text string, source string, copy int")
    out = mix(docs, alpha=1.0)
    assert out.columns == ["doc_id", "text", "source", "copy", "n_copies", "copy_", "shuffle_key"]
    keys = [r["shuffle_key"] for r in out.collect()]
    assert keys == sorted(keys)
    assert mix(docs.limit(0)).collect() == []


def test_rows_without_id_draw_each_for_itself(spark):
    docs = spark.createDataFrame([(None, "same", "a")] * 2000 + [(i, "t", "b") for i in range(500)], "doc_id long, text string, source string")
    w = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    out = mix(docs, weights=w)
    own = out.where("source = 'a'")
    assert abs(own.count() - 1250) < 130
    held = [r[0] for r in own.select(F.spark_partition_id().alias("p")).groupBy("p").count().select("count").collect()]
    assert len(held) >= 6 and max(held) < 2 * sum(held) / len(held)
    assert sorted(map(str, out.collect())) == sorted(map(str, mix(docs, weights=w).collect()))
