"""The corpus pipeline: five stages applied one after the other to ``documents``.

Each stage calls one operator of ``tickscan.llm`` on all that its predecessor kept; its result is
written as Parquet to the folder in spark.checkpoint.dir and read again as the next one's docs:

1. toxicity: documents that the classifier rejects go;
2. ngram_jaccard: one document of each group of near duplicates stays, that of the smallest id (five
   words and a similarity of 0.8, the general rule for near duplicates; the query op5 has its own);
3. substring_dedup: passages that stand in an earlier document are cut from the text (n_chars
   follows); a document of which nothing is left goes;
4. decontaminate: documents contaminated with benchmark items go;
5. mix: documents are repeated to the sources' target weights and shuffled.

All but the last return the columns of documents. Rows with null ids, texts or other columns go
through all stages (see each operator); an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickscan.llm.common import drop, keep, table
from tickscan.llm.decontaminate import remove_contaminated
from tickscan.llm.mixing import mix
from tickscan.llm.ngram_jaccard import keep_first
from tickscan.llm.substring_dedup import substring_dedup
from tickscan.llm.toxicity import remove_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_toxic(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs, k=5, percent=80)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = substring_dedup(docs)
    n_words, n_removed, _ = out.columns[-3:]
    cut = F.col(n_removed) > 0
    out = out.where(~cut | (F.col(n_removed) < F.col(n_words)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [("toxicity", toxicity), ("ngram_jaccard", ngram_jaccard), ("substring_dedup", substring),
          ("decontaminate", decontaminate), ("mix", mixing)]

#: Learning, MinHash and components can't be stated in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
