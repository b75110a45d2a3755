"""File sinks: ticks split by symbol (and region), and the topic capture.

``split_by_symbol`` writes one folder per symbol (``id=<symbol>``), optionally under one folder per
region, with a header line. Rows are not shuffled by symbol: a symbol holding a third of the
rows would otherwise be written by one task. ``files_per_symbol`` bounds the file count instead by
hashing rows into that many buckets per symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import region_of


def to_raw_rows(ticks: DataFrame) -> DataFrame:
    """Ticks in the raw file layout: the five needed columns under their file header names, as text."""
    ts = F.col("trade_timestamp")
    return ticks.select(F.col("id").alias("ID"), F.col("sec_type").alias("SecType"), F.col("last").alias("Last"),
                        F.date_format(ts, "dd-MM-yyyy").alias("Trading date"),
                        F.date_format(ts, "HH:mm:ss.SSSSSS").alias("Trading time"))


def split_by_symbol(raw: DataFrame, path: str, by_region: bool = False, files_per_symbol: int = 8,
                    id_col: str = "ID") -> None:
    """Write raw rows as CSV with a header, one folder per symbol (``symbol=<id>``), under one folder
    per region (``region=<r>``) when asked. The ``ID`` column stays in the files."""
    df = raw.withColumn("symbol", F.col(id_col))
    cols = ["symbol"]
    if by_region:
        df = df.withColumn("region", region_of(id_col))
        cols = ["region", "symbol"]
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]), F.lit(files_per_symbol))
    df = df.repartition(*[F.col(c) for c in cols], bucket)
    df.write.mode("overwrite").partitionBy(*cols).option("header", "true").csv(path)


def capture(records: DataFrame, path: str, benchmark_col: str = "benchmark_timestamp") -> None:
    """Append captured topic records as CSV, one folder per topic, stamped with the capture time in
    milliseconds. Columns must be flat (:func:`~tickscan.sources.kafka.flat_message`)."""
    (records.withColumn(benchmark_col, F.unix_millis(F.current_timestamp()))
            .write.mode("append").partitionBy("topic").option("header", "true").csv(path))


def capture_batch(path: str):
    """``foreachBatch`` function for a capture stream."""
    def _write(df: DataFrame, _batch_id: int) -> None:
        capture(df, path)
    return _write


RAW_EXTRA_COLUMN = "Extra"


def write_day_files(raw: DataFrame, path: str, preamble: list[str], description: dict[str, str] | None = None,
                    orders: dict[str, list[str]] | None = None, extra: Column | None = None) -> None:
    """Write raw rows (``to_raw_rows`` layout) as exchange day files: one file per region and trade
    day, each with the preamble lines, a header, a description line, then the rows in trade order.

    ``orders`` maps a region to its column order (default: the layout order); ``extra`` fills the
    column that readers ignore. Lines are built as
    text and written with one task per file, the file being the unit of the format (a day of one
    region); rows are ordered inside the file by ``sortWithinPartitions``.
    """
    from ..schemas import RAW_REQUIRED_COLUMNS

    def csv_cell(c):
        s = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        return F.when(s.rlike('[,"\r\n]'),
                      F.concat(F.lit('"'), F.regexp_replace(s, '"', '""'), F.lit('"'))).otherwise(s)

    base = RAW_REQUIRED_COLUMNS + [RAW_EXTRA_COLUMN]
    desc = description or {}
    rows = (raw.withColumn(RAW_EXTRA_COLUMN, F.lit("x") if extra is None else extra)
               .withColumn("region", region_of("ID"))
               .withColumn("day", F.regexp_replace(F.col("`Trading date`"), "-", "")))
    orders = orders or {}
    line = None
    head = None
    dline = None
    for region, cols in list(orders.items()) + [(None, base)]:
        cols = list(cols)
        l_ = F.concat_ws(",", *[csv_cell(c) for c in cols])
        h_ = F.lit(",".join(cols))
        d_ = F.lit(",".join('"' + desc.get(c, c) + '"' for c in cols))
        if region is None:
            line = l_ if line is None else line.otherwise(l_)
            head = h_ if head is None else head.otherwise(h_)
            dline = d_ if dline is None else dline.otherwise(d_)
        else:
            cond = F.col("region") == F.lit(region)
            line = F.when(cond, l_) if line is None else line.when(cond, l_)
            head = F.when(cond, h_) if head is None else head.when(cond, h_)
            dline = F.when(cond, d_) if dline is None else dline.when(cond, d_)
    data = rows.select("region", "day", F.lit(2).alias("_part"), F.col("`Trading time`").alias("_t"),
                       line.alias("value"))
    keys = rows.select("region", "day").distinct()
    pre = keys.select("region", "day", F.lit(0).alias("_part"), F.lit("").alias("_t"),
                      F.inline(F.array(*[F.struct(F.lit(f"{i:02d}").alias("_o"), F.lit(t).alias("value"))
                                         for i, t in enumerate(preamble)]))) \
              .select("region", "day", "_part", F.col("_o").alias("_t"), "value")
    hdr = (rows.select("region", "day", head.alias("h"), dline.alias("d")).distinct()
               .select("region", "day", F.lit(1).alias("_part"),
                       F.inline(F.array(F.struct(F.lit("0").alias("_t"), F.col("h").alias("value")),
                                        F.struct(F.lit("1").alias("_t"), F.col("d").alias("value"))))))
    lines = data.unionByName(pre).unionByName(hdr)
    (lines.repartition("region", "day").sortWithinPartitions("region", "day", "_part", "_t")
          .select("region", "day", "value")
          .write.mode("overwrite").partitionBy("region", "day").text(path))
