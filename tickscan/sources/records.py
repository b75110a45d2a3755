"""Quoted CSV records of large text files, cut exactly by many tasks at once.

A quoted cell may hold line ends, so a line is not a record, and whether a line starts inside quotes
depends on everything before it. Each line maps the state before it (0: a record starts, 1: inside a
quoted cell) to the state after it; so does each block of a file (the lines Spark reads as one split). The
scan follows both states at once and counts the records that start under each. Composing the
blocks' maps along a file, a few numbers for each block, gives every block's true first state and the
number of records before it, and with them each line's record number. Records of one line, nearly all,
are taken as they are; only lines of longer ones are brought together.

A task scans many blocks, however small Spark's splits are: ``TASK_BYTES`` of text, or as much as gives
every core some tasks. The number of tasks (and of files written) follows the bytes and not the splits.

The body is scanned once and written once (``Lines.written``); blocks and records are read from that.
A record of more than ``MAX_RECORD_LINES`` lines means a quote that nobody closes: it is listed in
``Records.unclosed`` with its number of lines and not put together.

Quotes count as CSV readers count them: a cell is quoted if it begins with one, two inside stand for
one, text after the closing quote belongs to the cell, a quote inside an unquoted cell is text.
Lines end at a line feed; a carriage return before it goes at a record's end and stays inside a cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_written, write_and_read

MAX_RECORD_LINES = 10_000
#: Text that a scanning task reads at least, if every core has ``TASKS_PER_CORE`` tasks.
TASK_BYTES = 64 << 20
TASKS_PER_CORE = 4
MAX_TASKS = "spark.sql.files.maxPartitionNum"
ROW_SCHEMA = ("file string, block long, line long, value string, before0 int, before1 int, after0 int, after1 int, "
              "count0 long, count1 long")


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the end of ``line`` is inside a quoted cell if its start is (or not)."""
    at = 0
    while True:
        if inside:
            end = line.find('"', at)
            while end >= 0 and line[end + 1:end + 2] == '"':
                end = line.find('"', end + 2)
            if end < 0:
                return True
            at = end + 1
        elif line[at:at + 1] == '"':
            at, inside = at + 1, True
            continue
        comma = line.find(",", at)
        if comma < 0:
            return False
        at, inside = comma + 1, False


def _follow(values: pa.Array, state: list[int], count: list[int]) -> tuple[np.ndarray, ...]:
    """States before and after each line and records started up to it, from each of two states."""
    n = len(values)
    before, after, counts = np.empty((2, n), np.int32), np.empty((2, n), np.int32), np.empty((2, n), np.int64)
    quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
    moves = {int(i): (int(ends_inside(v, False)), int(ends_inside(v, True))) for i, v in zip(quoted, values.take(pa.array(quoted)).to_pylist())}
    for s in (0, 1):
        now, done = state[s], 0
        for i in [*moves, n]:  # between lines with quotes the state stays
            before[s, done:i], after[s, done:i] = now, now
            if i < n:
                before[s, i] = now
                now = moves[i][now]
                after[s, i] = now
            done = i + 1
        counts[s] = count[s] + np.cumsum(before[s] == 0)
        state[s] = now
        count[s] = int(counts[s, -1])
    return before[0], before[1], after[0], after[1], counts[0], counts[1]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, value) in reading order -> rows of ``ROW_SCHEMA``."""
    names = [c.strip().split()[0] for c in ROW_SCHEMA.split(",")]
    place, line, state, count = None, 0, [0, 1], [0, 0]
    for batch in batches:
        if not len(batch):
            continue
        t, found = pa.table(batch), []
        file, block, value = (t[c].combine_chunks() for c in ("file", "block", "value"))
        same = np.ones(len(t), bool)
        if len(t) > 1:
            same[1:] = pc.and_(pc.equal(file.slice(1), file.slice(0, len(t) - 1)),
                               pc.equal(block.slice(1), block.slice(0, len(t) - 1))).to_numpy(zero_copy_only=False)
        cuts = [0, *np.flatnonzero(~same).tolist(), len(t)]
        for a, b in zip(cuts, cuts[1:]):
            here = (file[a].as_py(), block[a].as_py())
            if here != place:
                place, line, state, count = here, 0, [0, 1], [0, 0]
            found.append((np.arange(line, line + b - a), *_follow(value.slice(a, b - a), state, count)))
            line += b - a
        lines, *cols = (pa.array(np.concatenate(c)) for c in zip(*found))
        yield pa.RecordBatch.from_arrays([file, block, lines, value, *cols], names)


@dataclass
class Records:
    records: DataFrame    # file, record (its number in the file, from 0), value
    unclosed: DataFrame   # file, record, lines
    written: DataFrame    # what both read; see release()

    def release(self) -> None:
        """Delete the written lines when the records are no longer needed."""
        drop_written(self.written)


def read_records(spark: SparkSession, paths, path_glob: str = "*.csv", recursive: bool = True,
                 max_lines: int = MAX_RECORD_LINES) -> Records:
    """The CSV records of all files under ``paths``, as text."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = lambda: spark.read.option("pathGlobFilter", path_glob).option("recursiveFileLookup", str(recursive).lower())
    size = files().format("binaryFile").load(paths).agg(F.sum("length")).first()[0] or 0
    text = (files().option("lineSep", "\n").text(paths)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))
    held = spark.conf.get(MAX_TASKS, None)
    spark.conf.set(MAX_TASKS, str(max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))))
    try:
        lines = write_and_read(text.mapInArrow(_scan, ROW_SCHEMA), "lines", spark)
    finally:
        if held is None:
            spark.conf.unset(MAX_TASKS)
        else:
            spark.conf.set(MAX_TASKS, held)
    return cut_records(lines, max_lines)


def _block_states(lines: DataFrame) -> DataFrame:
    """(b_file, b_block, state, first): the state that each block starts in and the records before it.

    A block either fixes the state after it, whatever it was, or keeps or flips it; the last one that
    fixed it and the flips since tell the state. One row for each block."""
    last = lines.groupBy("file", "block").agg(F.max_by(F.struct("after0", "after1", "count0", "count1"), "line").alias("e"))
    along = Window.partitionBy("file").orderBy("block")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = last.select("file", "block", "e.*")
    b = b.withColumn("flips", F.sum(F.when((F.col("after0") == 1) & (F.col("after1") == 0), 1).otherwise(0)).over(upto))
    fixed = F.when(F.col("after0") == F.col("after1"), (F.col("after0") + F.col("flips")) % 2)
    b = b.withColumn("base", F.last(fixed, ignorenulls=True).over(upto))
    b = b.withColumn("end", (F.coalesce("base", F.lit(0)) + F.col("flips")) % 2)
    b = b.withColumn("state", F.lag("end", 1, 0).over(along))
    b = b.withColumn("n", F.when(F.col("state") == 0, F.col("count0")).otherwise(F.col("count1")))
    return b.select(F.col("file").alias("b_file"), F.col("block").alias("b_block"), "state", (F.sum("n").over(upto) - F.col("n")).alias("first"))


def cut_records(lines: DataFrame, max_lines: int = MAX_RECORD_LINES) -> Records:
    at = lines.join(_block_states(lines), (F.col("file") == F.col("b_file")) & (F.col("block") == F.col("b_block")))
    pick = lambda c: F.when(F.col("state") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1"))
    at = at.select("file", "block", "line", "value", pick("before").alias("before"), pick("after").alias("after"),
                   (F.col("first") + pick("count") - 1).alias("record"))
    alone = at.where("before = 0 and after = 0").select("file", "record", "value")
    parts = at.where("before = 1 or after = 1")
    size = parts.groupBy("file", "record").agg(F.count("*").alias("lines"))
    unclosed = size.where(F.col("lines") > max_lines)
    few = size.where(F.col("lines") <= max_lines).select(F.col("file").alias("s_file"), F.col("record").alias("s_record"))
    parts = parts.join(few, (F.col("file") == F.col("s_file")) & (F.col("record") == F.col("s_record")))
    whole = parts.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("p"))
    whole = whole.select("file", "record", F.array_join(F.col("p.value"), "\n").alias("value"))
    records = alone.union(whole).withColumn("value", F.regexp_replace("value", "\r$", ""))
    return Records(records, unclosed, lines)


def cells(record: Column) -> Column:
    """The cells of a CSV record as text, quotes taken off."""
    plain = F.split(record, ",", -1)
    # every match takes the comma before its cell, so none is empty
    quoted = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(r',("(?:[^"]++|"")*+(?:"[^,]*+|$)|[^,]*+)'), F.lit(1))
    text = F.transform(quoted, lambda c: F.when(c.startswith('"'), F.concat(
        F.regexp_replace(F.regexp_extract(c, r'^"((?:[^"]++|"")*+)', 1), '""', '"'),
        F.regexp_extract(c, r'^"(?:[^"]++|"")*+"?(.*)$', 1))).otherwise(c))
    return F.when(record.contains('"'), text).otherwise(plain)
