"""Batch ledger and file index of a history table: which files may hold a key, which batches are in.

All live in folders of the table whose names start with an underscore, which Spark's readers skip:

* ``_index/trade_date=.../``: one row for each data file of that day with its key range and a Bloom
  filter of its keys. Data files never change, so a row stays true; a row is whole or absent. Files
  without one (of a batch that died before its index was written, or put there by another program) are
  opened by every insert into their day, and indexed by it.
* ``_latest/``: (symbol, latest) of every batch written and file indexed; a symbol's latest time is the
  greatest of its few rows here, so history queries need no scan of the table for it.
* ``_compacted/`` and ``_swaps/``: files that stand for several small ones, and which for which
  (``sinks/compact.py``); a table's files are those of its days, as swapped.
* ``_batches/<token>``: an empty file for each batch whose rows and index are in, put there by one
  rename. A batch that finds its token does nothing.

The filter is a set of bitmap pages built by Spark's own bitmap aggregates: ``PROBES`` hashes of a key
name bits in ``PAGES`` pages of 32,768 bits. A key can only be in a file whose time and symbol ranges
hold it and whose bits are all set. Keys meet files by (day, hour slot of the file's time range), so
that a day with many files costs a key only those that overlap its own hour.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PARTITION_COLUMN

PROBES = 4
#: Pages of 32,768 bits for so many keys of a file (12 bits a key: about 1 in 200 keys is asked for in vain).
KEYS_PER_PAGE = 2_730
PAGE_BITS = 32_768
SLOT_SECONDS = 3_600
INDEX, BATCHES, LATEST = "_index", "_batches", "_latest"
COMPACTED, SWAPS = "_compacted", "_swaps"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def listed(spark: SparkSession, folder: str) -> dict[str, tuple[str, int]]:
    """(full path, bytes) by name of the data files in a folder, if it is there."""
    fs, p = _fs(spark, folder)
    out = {}
    if fs.exists(p):
        each = fs.listStatusIterator(p)
        while each.hasNext():
            f = each.next()
            if f.isFile() and not f.getPath().getName().startswith(("_", ".")):
                out[f.getPath().getName()] = (f.getPath().toString(), f.getLen())
    return out


def swaps(spark: SparkSession, path: str) -> dict[str, dict]:
    """The committed swaps by marker name: {"add": names, "remove": names}."""
    out = {}
    for name, (file, _) in listed(spark, f"{path}/{SWAPS}").items():
        text = "\n".join(r[0] for r in spark.read.text(file).collect())
        out[name] = json.loads(text)
    return out


def days_of(spark: SparkSession, path: str) -> list[str]:
    """The days that the table has a folder for."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(PARTITION_COLUMN + "="))


def sized_files(spark: SparkSession, path: str, days: list) -> dict[str, tuple[str, int]]:
    """(full path, bytes) of the data files of the given days by name relative to the table."""
    swapped = swaps(spark, path)
    gone = {n for s in swapped.values() for n in s["remove"]}
    added = {n for s in swapped.values() for n in s["add"]}
    out = {}
    for d in days:
        day = f"{PARTITION_COLUMN}={d}"
        out |= {f"{day}/{n}": f for n, f in listed(spark, f"{path}/{day}").items()}
        if added:
            out |= {f"{day}/{n}": f for n, f in listed(spark, f"{path}/{COMPACTED}/{day}").items() if f"{day}/{n}" in added}
    return {n: f for n, f in out.items() if n not in gone}


def day_files(spark: SparkSession, path: str, days: list) -> dict[str, str]:
    """Data files of the given days: full path by name relative to the table."""
    return {n: f for n, (f, _) in sized_files(spark, path, days).items()}


def has_batch(spark: SparkSession, path: str, token: str) -> bool:
    fs, p = _fs(spark, f"{path}/{BATCHES}/{token}")
    return fs.exists(p)


def mark_batch(spark: SparkSession, path: str, token: str) -> None:
    fs, target = _fs(spark, f"{path}/{BATCHES}/{token}")
    _, draft = _fs(spark, f"{path}/{BATCHES}/.{uuid.uuid4().hex}")
    fs.create(draft, True).close()
    fs.rename(draft, target)


def _instant_us(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _bits(pages: Column, key: list[str]) -> Column:
    """The numbers of a key's bits in a filter of ``pages`` pages."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), *[F.col(k).cast("string") for k in key]), pages * PAGE_BITS) for i in range(PROBES)])


def index_rows(rows: DataFrame, key: list[str], ts_col: str) -> DataFrame:
    """One index row for each file of ``rows`` (key columns, the day, and the file's name as ``file``)."""
    size = rows.groupBy("file", PARTITION_COLUMN).agg(
        F.count("*").alias("n"), F.min("symbol").alias("low_symbol"), F.max("symbol").alias("high_symbol"),
        F.min(_instant_us(ts_col)).alias("low_us"), F.max(_instant_us(ts_col)).alias("high_us"))
    size = size.withColumn("pages", F.ceil(F.col("n") / KEYS_PER_PAGE).cast("long"))
    bits = rows.join(size.select(F.col("file").alias("_f"), "pages"), F.col("file") == F.col("_f"))
    bits = bits.select("file", F.explode(_bits(F.col("pages"), key)).alias("bit"))
    page = (bits.groupBy("file", F.expr(f"bit div {PAGE_BITS}").alias("page"))
            .agg(F.bitmap_construct_agg(F.col("bit") % PAGE_BITS).alias("bitmap")))
    page = page.groupBy(F.col("file").alias("_f")).agg(F.map_from_entries(F.collect_list(F.struct("page", "bitmap"))).alias("filter"))
    return size.join(page, F.col("file") == F.col("_f")).drop("_f")


INDEX_SCHEMA = ("file string, n long, low_symbol string, high_symbol string, low_us long, high_us long, pages long, "
                f"filter map<long,binary>, {PARTITION_COLUMN} date")


def day_spans(batch: DataFrame, ts_col: str) -> list:
    """(day, n, low_symbol, high_symbol, low_us, high_us) of each day of a batch: as many rows as it has days."""
    return batch.groupBy(PARTITION_COLUMN).agg(
        F.count("*").alias("n"), F.min("symbol").alias("low_symbol"), F.max("symbol").alias("high_symbol"),
        F.min(_instant_us(ts_col)).alias("low_us"), F.max(_instant_us(ts_col)).alias("high_us")).collect()


def latest_rows(rows: DataFrame, ts_col: str) -> DataFrame:
    """(symbol, latest): the side table's rows for ``rows``."""
    return rows.groupBy("symbol").agg(F.max(ts_col).alias("latest"))


def read_index(spark: SparkSession, path: str, days: list) -> DataFrame | None:
    fs, p = _fs(spark, f"{path}/{INDEX}")
    held = [f"{path}/{INDEX}/{PARTITION_COLUMN}={d}" for d in days]
    held = [h for h in held if fs.exists(_fs(spark, h)[1])]
    if not held:
        return None
    return spark.read.schema(INDEX_SCHEMA).option("basePath", f"{path}/{INDEX}").parquet(*held)


def write_index(spark: SparkSession, path: str, files: dict[str, str], key: list[str], ts_col: str,
                batch: DataFrame | None = None, schema: T.StructType | None = None) -> None:
    """Index the given data files (their key columns are read once more) and put the latest times of
    their rows and of ``batch`` into the side table. The side table comes first: a file that has an
    index row is never read for it again."""
    rows = None
    if files:
        name = F.regexp_extract(F.input_file_name(), rf"({PARTITION_COLUMN}=[^/]*/[^/]*)$", 1)
        rows = read_files(spark, path, files, schema).select(*key, PARTITION_COLUMN, F.url_decode(name).alias("file"))
    latest = latest_rows(batch, ts_col) if batch is not None else None
    if rows is not None:
        latest = latest_rows(rows, ts_col).union(latest) if latest is not None else latest_rows(rows, ts_col)
    if latest is not None:
        latest_rows(latest.withColumnRenamed("latest", ts_col), ts_col).coalesce(1).write.mode("append").parquet(f"{path}/{LATEST}")
    if rows is not None:
        (index_rows(rows, key, ts_col).coalesce(max(1, len(files) // 64))
            .write.mode("append").partitionBy(PARTITION_COLUMN).parquet(f"{path}/{INDEX}"))


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{LATEST}").groupBy("symbol").agg(F.max("latest").alias("latest"))


def read_files(spark: SparkSession, path: str, files: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
    """The rows of the given data files, with their day; with ``schema`` those columns, without a job
    that looks for them."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    parts = []
    for base in (path, f"{path}/{COMPACTED}"):
        mine = [f for f in files.values() if (f"/{COMPACTED}/" in f) == (base != path)]
        if mine:
            parts.append(reader.option("basePath", base).parquet(*mine))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


@dataclass
class Candidates:
    """Files of the touched days: all, those without an index row, and those that may hold a key."""

    files: dict[str, str]
    unlisted: dict[str, str]
    hit: dict[str, str]

    def to_open(self) -> dict[str, str]:
        return self.unlisted | self.hit


def candidates(batch: DataFrame, path: str, spans: list, key: list[str], ts_col: str) -> Candidates:
    """The stored files that an insert of ``batch`` (with its day column and ``day_spans``) must look into."""
    spark = batch.sparkSession
    days = [r[PARTITION_COLUMN] for r in spans]
    files = day_files(spark, path, days)
    index = read_index(spark, path, days) if files else None
    if index is None:
        return Candidates(files, dict(files), {})
    # one short row for each file of the batch's days
    held = index.select(PARTITION_COLUMN, "file", "low_symbol", "high_symbol", "low_us", "high_us").collect()
    span = {r[PARTITION_COLUMN]: r for r in spans}
    near = {r["file"] for r in held if r["file"] in files and (s := span.get(r[PARTITION_COLUMN])) is not None
            and r["low_symbol"] <= s["high_symbol"] and r["high_symbol"] >= s["low_symbol"]
            and r["low_us"] <= s["high_us"] and r["high_us"] >= s["low_us"]}
    known = {r["file"] for r in held}
    unlisted = {f: p for f, p in files.items() if f not in known}
    if not near:
        return Candidates(files, unlisted, {})
    near = index.where(F.col("file").isin(list(near))).dropDuplicates(["file"])
    slot = SLOT_SECONDS * 1_000_000
    near = near.withColumn("_slot", F.explode(F.sequence(F.expr(f"low_us div {slot}"), F.expr(f"high_us div {slot}"))))
    near = near.withColumnRenamed(PARTITION_COLUMN, "_day")
    asked = batch.select(*key, PARTITION_COLUMN, _instant_us(ts_col).alias("_us")).withColumn("_slot", F.expr(f"_us div {slot}"))
    met = asked.join(near, "_slot").where(
        (F.col(PARTITION_COLUMN) == F.col("_day")) & F.col("_us").between(F.col("low_us"), F.col("high_us"))
        & F.col("symbol").between(F.col("low_symbol"), F.col("high_symbol")))
    held = F.lit(True)
    for i in range(PROBES):
        page, at = F.expr(f"_bits[{i}] div {PAGE_BITS}"), F.expr(f"cast(_bits[{i}] % {PAGE_BITS} as int)")
        byte = F.conv(F.hex(F.substring(F.col("filter")[page], F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held &= F.coalesce(F.getbit(byte, at % 8), F.lit(0)) == 1  # a page without any bit is not stored
    hit = met.withColumn("_bits", _bits(F.col("pages"), key)).where(held).select("file").distinct()
    hit = {r["file"] for r in hit.collect()}
    return Candidates(files, unlisted, {f: p for f, p in files.items() if f in hit})
