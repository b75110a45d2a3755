"""The pipeline over planted cases, stage by stage, and against its stages' own operators."""
import random

import corpus_pipeline as P
from pyspark.sql import functions as F

from tickscan.llm.mixing import mix


def tables(spark, folder):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    fresh = lambda n: [word() for _ in range(n)]
    rows = {i: fresh(120) for i in range(300)}
    for i in range(0, 300, 10):  # toxic
        for j in (3, 40, 77):
            rows[i][j] = rnd.choice(["scumbag", "vermin", "lowlife"])
    rows[301], rows[302] = list(rows[1]), list(rows[2])
    rows[302][60] = "changed"
    passage, item = fresh(60), fresh(30)
    for i in (3, 4, 305):
        rows[i] = (rows[i] if i < 300 else fresh(120)) + passage + fresh(20)
    rows[306] = fresh(50) + item + fresh(50)
    rows[307] = list(passage)
    docs = [(i, " ".join(w), "en", "src%d" % (i % 3), 0) for i, w in rows.items()] + [(400, None, None, None, None), (401, "", "en", "src1", 0), (None, "no id", "en", "src1", 5)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, passage


def test_stages(spark, tmp_path):
    sf = f"file://{tmp_path}"
    rows, passage = tables(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in P.STAGES:
        docs = P.keep(stage(spark, docs, sf), f"test-{name}")
        seen.append({r["doc_id"]: r for r in docs.collect()})
        assert docs.columns[:5] == columns and (name == "mix" or docs.columns == columns)
    toxic, near, cut, clean, mixed = seen
    everyone = set(rows) | {400, 401, None}
    assert everyone - set(toxic) == set(range(0, 300, 10))
    assert set(toxic) - set(near) == {301, 302}
    assert set(near) - set(cut) == {307}
    assert cut[3]["text"] == near[3]["text"]
    for i in (4, 305):
        assert not set(cut[i]["text"].split()) & set(passage) and cut[i]["n_chars"] == len(cut[i]["text"])
    assert all(cut[i]["text"] == near[i]["text"] for i in cut if i not in (4, 305))
    assert set(cut) - set(clean) == {306}
    want = mix(spark.createDataFrame([tuple(r) for r in clean.values()], docs.select(*columns).schema)).collect()
    assert sorted(map(str, want)) == sorted(map(str, docs.collect()))
    assert sorted(map(str, P.run(spark, sf).collect())) == sorted(map(str, docs.collect()))
