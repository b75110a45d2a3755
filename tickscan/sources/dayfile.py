"""Raw exchange files as ticks (batch).

Two layouts are read:

* **day file** - 11 preamble lines, a header line (cells trimmed), a line describing the columns,
  then data rows; comma separated, ``"`` quoted.
* **per-symbol file** - header line, then data rows.

Only five columns are needed, found **by name** (``ID, SecType, Last, Trading date,
Trading time``); others are ignored. A file lacking one of them is rejected (listed, not read)
and the others go on.

Files are cut into records by ``sources/records.py`` (quoted cells may hold line ends), in one scan
of their bytes. The header of each file becomes one row, (file, place of each needed column), that
the records of the file join; nothing of a file reaches the driver but the names of empty ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ticks import parse_trade_ts
from ..schemas import RAW_PREAMBLE_LINES, RAW_REQUIRED_COLUMNS
from .records import Records, cells, read_records

DAY_FILE = (RAW_PREAMBLE_LINES, RAW_PREAMBLE_LINES + 2)   # number of the header record, of the first data record
SYMBOL_FILE = (0, 1)


@dataclass
class TickFiles:
    ticks: DataFrame          # id, sec_type, last, trade_timestamp, wallclock_timestamp, delay, seq, file
    rejected: DataFrame       # file, missing (array of missing column names)
    unclosed: DataFrame       # file, record, lines: a quote that is never closed (see sources/records.py)
    source: Records

    def release(self) -> None:
        """Delete what was written for the frames above when they are no longer needed."""
        self.source.release()


def file_names(spark: SparkSession, paths, path_glob: str = "*.csv", recursive: bool = True) -> DataFrame:
    """All input files that hold anything (names only, no content is read)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.format("binaryFile").option("pathGlobFilter", path_glob)
            .option("recursiveFileLookup", str(recursive).lower()).load(paths).select(F.col("_metadata.file_path").alias("file")))


def empty_files(spark: SparkSession, paths, path_glob: str = "*.csv") -> list[str]:
    """Names of input files of no bytes: Spark's scans leave them out, so the store is asked."""
    jvm, found = spark.sparkContext._jvm, []
    for path in [paths] if isinstance(paths, str) else list(paths):
        root = jvm.org.apache.hadoop.fs.Path(path)
        each = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
        while each.hasNext():
            f = each.next()
            if f.getLen() == 0 and fnmatch(f.getPath().getName(), path_glob):
                found.append(f.getPath().toString())
    return found


def ticks_of(records: DataFrame, heads: DataFrame) -> DataFrame:
    """Ticks of data records (file, record, value); ``heads`` has (h_file, places) of each file."""
    r = records.join(heads, F.col("file") == F.col("h_file")).withColumn("c", cells(F.col("value")))
    c = {name: F.try_element_at("c", F.col("places")[i].cast("int")) for i, name in enumerate(RAW_REQUIRED_COLUMNS)}
    text = {name: F.when(v != "", v) for name, v in c.items()}  # an empty cell is no value
    return r.select(
        F.trim(text["ID"]).alias("id"), text["SecType"].alias("sec_type"), F.trim(text["Last"]).alias("last"),
        parse_trade_ts(text["Trading date"], text["Trading time"]).alias("trade_timestamp"),
        F.lit(None).cast("timestamp").alias("wallclock_timestamp"), F.lit(None).cast("long").alias("delay"),
        F.col("record").alias("seq"), "file")


def read_tick_files(spark: SparkSession, paths, layout=DAY_FILE, path_glob: str = "*.csv") -> TickFiles:
    """Ticks from raw files; see the module doc. ``layout`` is (header record, first data record)."""
    header_at, data_from = layout
    source = read_records(spark, paths, path_glob)
    head = source.records.where(F.col("record") == header_at).select(F.col("file").alias("h_file"), cells(F.col("value")).alias("names"))
    names = F.transform(F.coalesce("names", F.array().cast("array<string>")), lambda n: F.trim(n))
    all_files = file_names(spark, paths, path_glob)
    empty = spark.createDataFrame([(f,) for f in empty_files(spark, paths, path_glob)], "file string")
    heads = (all_files.union(empty).distinct().join(head, F.col("file") == F.col("h_file"), "left")
             .select("file", names.alias("names")))
    missing = F.array_except(F.array(*[F.lit(c) for c in RAW_REQUIRED_COLUMNS]), F.col("names"))
    heads = heads.select("file", missing.alias("missing"),
                         F.array(*[F.array_position("names", F.lit(c)) for c in RAW_REQUIRED_COLUMNS]).alias("places"))
    data = source.records.where((F.col("record") >= data_from) & (F.col("value") != ""))
    good = heads.where("size(missing) = 0").select(F.col("file").alias("h_file"), "places")
    return TickFiles(ticks_of(data, good), heads.where("size(missing) > 0").select("file", "missing"), source.unclosed, source)


def read_day_files(spark: SparkSession, paths, path_glob: str = "*.csv") -> TickFiles:
    return read_tick_files(spark, paths, DAY_FILE, path_glob)


def read_symbol_files(spark: SparkSession, paths, path_glob: str = "*.csv") -> TickFiles:
    return read_tick_files(spark, paths, SYMBOL_FILE, path_glob)
