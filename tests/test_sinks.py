"""Insert-if-absent history tables and file sinks (FIXTURES: replay leaves tables unchanged)."""
import os
from datetime import datetime

from tickscan.sinks.files import split_by_symbol, to_raw_rows
from tickscan.sinks.tables import write_advisories, write_ema_rows
from tickscan.sources.catalogs import read_regions, read_symbols, read_topics, write_regions, write_symbols, write_topics
from tickscan.operators.catalog import catalog_topics


def test_insert_if_absent(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "ema")
    rows = spark.createDataFrame(
        [("A.FR", 1.0, 2.0, datetime(2024, 1, 1, 10)), ("A.FR", 1.5, 2.5, datetime(2024, 1, 2, 10)),
         ("B.NL", 3.0, 4.0, datetime(2024, 1, 1, 11))], "symbol string, ema38 double, ema100 double, trade_timestamp timestamp")
    write_ema_rows(rows.limit(1), p)
    write_ema_rows(rows, p)
    write_ema_rows(rows, p)                               # replay: nothing added
    changed = spark.createDataFrame([("A.FR", 9.0, 9.0, datetime(2024, 1, 1, 10))], rows.schema)
    write_ema_rows(changed, p)                            # first writer wins
    t = spark.read.parquet(p)
    assert t.count() == 3
    assert t.where("symbol = 'A.FR' AND ema38 = 9.0").count() == 0
    assert sorted(r["trade_date"].isoformat() for r in t.select("trade_date").distinct().collect()) == ["2024-01-01", "2024-01-02"]


def test_advisories_renamed(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "adv")
    rows = spark.createDataFrame([("A.FR", datetime(2024, 1, 1, 10), "Buy!")], "symbol string, trade_timestamp timestamp, message string")
    write_advisories(rows, p)
    write_advisories(rows, p)
    assert [r["advice"] for r in spark.read.parquet(p).collect()] == ["Buy!"]


def test_split_by_symbol(spark, tmpdir_path):
    from tickscan.sources.dayfile import read_symbol_files
    ticks = spark.createDataFrame([("A.FR", "E", "1", datetime(2024, 1, 1, 10)), ("A.FR", "E", "2", datetime(2024, 1, 1, 11)),
                                   ("B.NL", "E", "3", datetime(2024, 1, 1, 12))],
                                  "id string, sec_type string, last string, trade_timestamp timestamp")
    out = os.path.join(tmpdir_path, "split")
    split_by_symbol(to_raw_rows(ticks), out, by_region=True, files_per_symbol=2)
    assert sorted(n for n in os.listdir(out) if n.startswith("region=")) == ["region=FR", "region=NL"]
    assert os.listdir(os.path.join(out, "region=FR")) == ["symbol=A.FR"]
    back = read_symbol_files(spark, out).ticks
    assert sorted((r["id"], r["last"], r["trade_timestamp"]) for r in back.collect()) == \
        sorted((r["id"], r["last"], r["trade_timestamp"]) for r in ticks.collect())


def test_catalog_round_trip(spark, tmpdir_path):
    regions = spark.createDataFrame([("FR",), ("NL",), ("ETR",)], "region string")
    write_regions(regions, os.path.join(tmpdir_path, "regions"))
    assert sorted(r["region"] for r in read_regions(spark, os.path.join(tmpdir_path, "regions")).collect()) == ["ETR", "FR", "NL"]
    write_symbols(spark.createDataFrame([("B.NL",), ("A.FR",)], "symbol string"), os.path.join(tmpdir_path, "symbols"))
    assert [r["symbol"] for r in read_symbols(spark, os.path.join(tmpdir_path, "symbols")).collect()] == ["A.FR", "B.NL"]
    write_topics(catalog_topics(regions), os.path.join(tmpdir_path, "topics"))
    t = read_topics(spark, os.path.join(tmpdir_path, "topics"))
    assert t.count() == 9 and t.where("name = 'FR-ticks' AND partitions = 10").count() == 1
