"""Raw file scans: layout, header by name, rejected files, ragged and bad rows (FIXTURES section 2)."""
import os

from pyspark.sql import functions as F

from tickscan.operators.clean import quarantine, valid_ticks
from tickscan.sources.dayfile import read_day_files, read_symbol_files

PRE = "".join(f"preamble line {i}, with, commas\n" for i in range(11))
HEAD = "ID , SecType, Last, Trading date, Trading time, Extra\n"
DESC = 'Instrument, Type, "Last price, in EUR", Date, Time, Other\n'


def write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_day_files(spark, tmpdir_path):
    d = tmpdir_path
    write(d, "raw_ok.csv", PRE + HEAD + DESC
          + "AAA.FR,E,10.5,08-11-2021,10:00:00.100,x\n"
          + "BBB.NL,E,11,08-11-2021,10:00:01,y\n"
          + "CCC.ETR,E,,,,z\n")
    write(d, "missing_header.csv", PRE + "ID,SecType,Trading date,Trading time\n" + DESC + "DDD.FR,E,08-11-2021,10:00:00\n")
    write(d, "other_order.csv", PRE + "Trading time,Unknown,Last,ID,Trading date,SecType\n" + DESC
          + "10:00:02,u,12.5,EEE.FR,08-11-2021,E\n")
    write(d, "ragged.csv", PRE + HEAD + DESC + "FFF.FR,E\n" + "GGG.FR,E,1.5,08-11-2021,10:00:03,q\n")
    write(d, "bad_id.csv", PRE + HEAD + DESC + "AAA,E,1,08-11-2021,10:00:04,q\n" + "A.B.C,E,2,08-11-2021,10:00:05,q\n"
          + ",E,3,08-11-2021,10:00:06,q\n")
    write(d, "bad_price.csv", PRE + HEAD + DESC + 'HHH.FR,E,"",08-11-2021,10:00:07,q\n' + "HHH.FR,E,abc,08-11-2021,10:00:08,q\n"
          + "HHH.FR,E,1e3,08-11-2021,10:00:09,q\n" + "HHH.FR,E,-5,08-11-2021,10:00:10,q\n")
    write(d, "notes.txt", "not a csv\n")
    out = read_day_files(spark, d)
    rej = {os.path.basename(r["file"]): r["missing"] for r in out.rejected.collect()}
    assert rej == {"missing_header.csv": ["Last"]}
    v = {(r["id"], r["price"]) for r in valid_ticks(out.ticks).collect()}
    assert ("AAA.FR", 10.5) in v and ("BBB.NL", 11.0) in v
    assert ("EEE.FR", 12.5) in v                    # bound by name, not position
    assert ("GGG.FR", 1.5) in v and ("A.B.C", 2.0) in v
    assert ("HHH.FR", 1000.0) in v and ("HHH.FR", -5.0) in v
    q = {(r["id"], r["reason"]) for r in quarantine(out.ticks).collect()}
    assert ("CCC.ETR", "bad_timestamp") in q
    assert ("FFF.FR", "bad_timestamp") in q        # ragged row: missing cells
    assert ("AAA", "bad_id") in q and (None, "bad_id") in q
    assert quarantine(out.ticks).where((F.col("id") == "HHH.FR") & (F.col("reason") == "bad_price")).count() == 2
    # nothing of the preamble, header or description lines leaks through
    assert out.ticks.where(F.col("id").startswith("preamble") | (F.col("id") == "ID")
                           | (F.col("id") == "Instrument")).count() == 0
    assert out.ticks.count() == 13     # data rows of the five readable files


def test_symbol_files(spark, tmpdir_path):
    d = tmpdir_path
    write(d, "AAA.FR.csv", "ID,SecType,Last,Trading date,Trading time\nAAA.FR,E,1,08-11-2021,10:00:00\nAAA.FR,E,2,08-11-2021,10:00:01\n")
    write(d, "BBB.FR.csv", "Last,ID,SecType,Trading date,Trading time\n3,BBB.FR,E,08-11-2021,10:00:00\n")
    out = read_symbol_files(spark, d)
    got = sorted((r["id"], r["last"]) for r in out.ticks.collect())
    assert got == [("AAA.FR", "1"), ("AAA.FR", "2"), ("BBB.FR", "3")]
