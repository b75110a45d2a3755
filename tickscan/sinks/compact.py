"""Compaction of a history table's days.

A stream adds a few small files to its days with every batch. ``compact`` writes the rows of a day's
small files again as few large ones, in a hidden folder of the table, indexes them and then commits one
swap marker by a rename: from then on ``read_table`` and the inserts take the new files for the old ones. Nothing is
deleted or moved, so that readers that listed the old files go on reading them.

``vacuum`` later deletes what swaps have replaced, moves the new files to their days, and makes one
file of the side tables' many; it wants a moment without readers (a plain Parquet read of
the folder also sees the new files only from then on). Each of its steps can be repeated after a crash.

Both are the table's one writer's business, between two inserts.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EMA_TABLE_KEY, PARTITION_COLUMN
from ..session import drop_written, write_and_read
from . import ledger

TARGET_BYTES = 128 << 20


def _replaced(spark: SparkSession, path: str, days: list | None, target_bytes: int) -> tuple[dict[str, str], dict[str, int]]:
    """Small files of the days that have several, and into how many each day's go."""
    files = ledger.sized_files(spark, path, ledger.days_of(spark, path) if days is None else days)
    by_day: dict[str, dict[str, tuple[str, int]]] = {}
    for name, (file, size) in files.items():
        if size < target_bytes // 2:
            by_day.setdefault(name.split("/")[0].split("=", 1)[1], {})[name] = (file, size)
    out, count = {}, {}
    for day, small in by_day.items():
        n = max(1, -(-sum(size for _, size in small.values()) // target_bytes))
        if len(small) > n:
            out |= {name: file for name, (file, _) in small.items()}
            count[day] = n
    return out, count


def compact(spark: SparkSession, path: str, key=EMA_TABLE_KEY, ts_col: str = "trade_timestamp", days: list | None = None,
            target_bytes: int = TARGET_BYTES) -> int:
    """Replace the small files of each day by few of about ``target_bytes``; returns how many went."""
    old, count = _replaced(spark, path, days, target_bytes)
    if not old:
        return 0
    folder = f"{path}/{ledger.COMPACTED}"
    there = {d: set(ledger.listed(spark, f"{folder}/{PARTITION_COLUMN}={d}")) for d in count}
    rows = ledger.read_files(spark, path, old)
    per_day = F.create_map(*[x for d, n in count.items() for x in (F.lit(d), F.lit(n))])
    bucket = F.pmod(F.xxhash64(*key), per_day[F.col(PARTITION_COLUMN).cast("string")])
    (rows.repartition(PARTITION_COLUMN, bucket).sortWithinPartitions(PARTITION_COLUMN, *key)
        .write.mode("append").partitionBy(PARTITION_COLUMN).parquet(folder))
    new = {f"{PARTITION_COLUMN}={d}/{n}": f for d in count
           for n, (f, _) in ledger.listed(spark, f"{folder}/{PARTITION_COLUMN}={d}").items() if n not in there[d]}
    ledger.write_index(spark, path, new, list(key), ts_col)
    _commit(spark, path, {"add": sorted(new), "remove": sorted(old)})
    return len(old)


def _commit(spark: SparkSession, path: str, swap: dict) -> None:
    name = uuid.uuid4().hex
    fs, draft = ledger._fs(spark, f"{path}/{ledger.SWAPS}/.{name}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(swap).encode()))
    finally:
        out.close()
    fs.rename(draft, ledger._fs(spark, f"{path}/{ledger.SWAPS}/{name}.json")[1])


def vacuum(spark: SparkSession, path: str) -> None:
    """Make the swaps plain: see the module doc."""
    for marker, swap in ledger.swaps(spark, path).items():
        for name in swap["remove"]:
            for base in (path, f"{path}/{ledger.COMPACTED}"):
                fs, p = ledger._fs(spark, f"{base}/{name}")
                fs.delete(p, False)
        for name in swap["add"]:
            fs, p = ledger._fs(spark, f"{path}/{ledger.COMPACTED}/{name}")
            if fs.exists(p):
                fs.rename(p, ledger._fs(spark, f"{path}/{name}")[1])
        fs, p = ledger._fs(spark, f"{path}/{ledger.SWAPS}/{marker}")
        fs.delete(p, False)
    days = ledger.days_of(spark, path)
    names = spark.createDataFrame([(n,) for n in ledger.day_files(spark, path, days)], "file string")
    index = ledger.read_index(spark, path, days)
    if index is not None:
        live = index.join(names, "file", "left_semi").dropDuplicates(["file"]).select(*index.columns)
        _rewritten(spark, live, f"{path}/{ledger.INDEX}", PARTITION_COLUMN)
    if ledger._fs(spark, path)[0].exists(ledger._fs(spark, f"{path}/{ledger.LATEST}")[1]):
        _rewritten(spark, ledger.read_latest(spark, path).coalesce(1), f"{path}/{ledger.LATEST}")


def _rewritten(spark: SparkSession, rows: DataFrame, folder: str, by: str | None = None) -> None:
    """Write ``rows`` in place of all that ``folder`` holds: beside it first, then renamed."""
    kept = write_and_read(rows, "vacuum", spark)
    fs, new = ledger._fs(spark, f"{folder}-{uuid.uuid4().hex}")
    w = kept.write
    (w.partitionBy(by) if by else w).parquet(new.toString())
    _, old = ledger._fs(spark, folder)
    fs.delete(old, True)  # without it, files count as not indexed and are opened: slower, still right
    fs.rename(new, old)
    drop_written(kept)
