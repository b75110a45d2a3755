"""Compaction: rows unchanged, few files a day, readers undisturbed, inserts still right."""
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tickscan.sinks import ledger
from tickscan.sinks.compact import compact, vacuum
from tickscan.sinks.tables import latest_times, read_table, write_ema_rows
from test_ledger import count_is, ema, stored


def test_compaction(spark, tmpdir_path):
    e = os.path.join(tmpdir_path, "e")
    rows = [(f"S{j}.FR", 150 * k + j, 1.0) for k in range(12) for j in range(6)]
    for k in range(12):  # two days
        write_ema_rows(ema(spark, rows[6 * k:6 * k + 6]), e, files_per_day=2, token=f"q-{k}")
    days = ledger.days_of(spark, e)
    assert len(days) == 2 and len(ledger.day_files(spark, e, days)) >= 12
    want = stored(spark, e)
    before = read_table(spark, e)          # a reader that starts now
    held = before.inputFiles()
    assert compact(spark, e) == len(held)
    assert len(ledger.day_files(spark, e, days)) == 2 and stored(spark, e) == want
    assert before.count() == 72            # and goes on reading its files
    assert spark.read.parquet(e).count() == 72
    # inserts look into the new files: known keys stay, new ones come in, files of other hours stay closed
    done = write_ema_rows(ema(spark, [("S0.FR", 0, 9.0), ("S0.FR", 7, 9.0)]), e)
    assert done.opened == 1 and done.stored == 1
    want |= {("S0.FR", 7): 9.0}
    assert stored(spark, e) == want
    assert write_ema_rows(ema(spark, rows[:6]), e, token="q-0").known
    # compacted files are compacted again
    assert compact(spark, e) > 0 and stored(spark, e) == want
    assert compact(spark, e) == 0
    vacuum(spark, e)
    assert stored(spark, e) == want and spark.read.parquet(e).count() == 73
    assert ledger.swaps(spark, e) == {} and len(spark.read.parquet(e).inputFiles()) == 2
    assert ledger.read_index(spark, e, days).count() == 2
    assert write_ema_rows(ema(spark, [("S0.FR", 7, 5.0), ("Z.FR", 8, 5.0)]), e).opened <= 1
    count_is(spark, e, 74)
    assert {r["symbol"]: r["latest"] for r in latest_times(spark, e).collect()}["S5.FR"] == datetime(2024, 1, 1) + timedelta(minutes=150 * 11 + 5)


def test_crash_before_the_swap(spark, tmpdir_path, monkeypatch):
    """New files without a committed swap do not count; a vacuum that died half way can be repeated."""
    from tickscan.sinks import compact as C
    e = os.path.join(tmpdir_path, "e")
    for k in range(3):
        write_ema_rows(ema(spark, [("A.FR", k, 1.0), ("B.FR", k, 1.0)]), e)
    want = stored(spark, e)
    commit = C._commit
    monkeypatch.setattr(C, "_commit", lambda *a: None)
    compact(spark, e)
    assert stored(spark, e) == want
    monkeypatch.setattr(C, "_commit", commit)
    compact(spark, e)
    assert stored(spark, e) == want
    rewritten = C._rewritten

    def dies(*a):
        raise RuntimeError("gone")
    monkeypatch.setattr(C, "_rewritten", dies)
    try:
        vacuum(spark, e)
    except RuntimeError:
        pass
    monkeypatch.setattr(C, "_rewritten", rewritten)
    assert stored(spark, e) == want
    vacuum(spark, e)
    assert stored(spark, e) == want and spark.read.parquet(e).where(F.col("symbol") == "A.FR").count() == 3
