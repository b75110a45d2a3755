"""Plan properties the design relies on (checked on the physical plan, not on timings)."""
import re

from conftest import SF_SMALL
from tickscan.operators.bars import bars
from tickscan.operators.clean import valid_ticks
from tickscan.operators.ema import ema
from tickscan.plans import registry as R
from tickscan.sources.tables import events_as_ticks


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_start_filter_reaches_scan(spark):
    p = plan(R.q_start_align(spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts,", p)


def test_scan_reads_only_needed_columns(spark):
    p = plan(R.q_symbol_counts(spark, SF_SMALL))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "props" not in schema and "event_id" not in schema


def test_bars_aggregate_partially_before_shuffle(spark):
    p = plan(bars(valid_ticks(events_as_ticks(spark, SF_SMALL)), "1 minute"))
    lines = p.splitlines()
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert any("partial_max_by" in l for l in lines[ex:])


def test_top2_limited_before_shuffle(spark):
    p = plan(R.q_price_direction(spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_ema_shuffles_bars_once_by_block(spark):
    b = bars(valid_ticks(events_as_ticks(spark, SF_SMALL)), "1 minute")
    p = plan(ema(b, levels=2, with_previous=True))
    assert "Window [" not in p
    # every exchange of the scan is keyed by (symbol, block) or is the top fold over <= 64 nodes
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert all("_g" in k or re.fullmatch(r"symbol#\d+, \d+", k) or "w#" in k or "id#" in k for k in keys), keys


def test_history_reads_only_the_days_it_needs(spark):
    from tickscan.operators import history as hist
    table, times = R._ema_table(spark, SF_SMALL)
    for df in (hist.ema_history(table), hist.viewport(table), hist.viewport(table, shift_minutes=-15),
               hist.ema_history(table, times=times), hist.latest(table, times=times)):
        assert re.search(r"PartitionFilters: \[[^\]]*trade_date#", plan(df))


def test_history_by_the_side_table(spark):
    """No job while the plan is built, no scan of the table for the latest times, days pruned while it runs."""
    from tickscan.operators import history as hist
    table, times = R._ema_table(spark, SF_SMALL)
    path = table.inputFiles()[0].split("/trade_date=")[0].split("/")[-1]
    sc = spark.sparkContext
    sc.setJobGroup("building", "")
    frames = [hist.ema_history(table, times=times), hist.ema_history(table, "CLICK.FR", times=times),
              hist.viewport(table, times=times), hist.latest(table, times=times)]
    built = list(sc.statusTracker().getJobIdsForGroup("building"))
    sc.setJobGroup("running", "")
    assert built == []
    for df in frames:
        df.collect()
        p = plan(df)
        scans = re.findall(rf"FileScan parquet[^\n]*?Location: InMemoryFileIndex[^\n]*?{path}(?!/_latest)[^\n]*ReadSchema", p)
        assert all("dynamicpruning" in x or "Subquery" in x or "subquery" in x for x in scans), scans
        # days of the latest rows only
        read = {r["trade_date"] for r in df.select("trade_date").distinct().collect()} if "trade_date" in df.columns else set()
        assert len(read) <= 3
    assert path not in plan(hist.time_grid(table, times=times)).replace(f"{path}/_latest", "")


def test_sources_add_no_shuffle(spark):
    assert "Exchange" not in plan(events_as_ticks(spark, SF_SMALL))


def test_no_python_udf_in_batch_plans(spark):
    for name in ["crossovers", "ema_history", "latency_stats", "bars_1m"]:
        p = plan(R.QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p


def test_bars_hash_aggregate_with_integer_seq(spark):
    p = plan(bars(valid_ticks(events_as_ticks(spark, SF_SMALL)), "1 minute"))
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_packed_ordering_breaks_ties_by_seq(spark):
    from datetime import datetime
    t = datetime(1969, 12, 31, 23, 59, 59)
    ticks = spark.createDataFrame(
        [("A.FR", t, -5, 1.0), ("A.FR", t, 7, 2.0), ("A.FR", t, 3, 3.0),
         ("B.FR", datetime(2024, 1, 1), 9223372036854775807, 4.0), ("B.FR", datetime(2024, 1, 1), -9223372036854775808, 5.0)],
        "id string, trade_timestamp timestamp, seq long, price double")
    got = {r["symbol"]: r["close"] for r in bars(ticks, "1 minute").collect()}
    assert got == {"A.FR": 2.0, "B.FR": 4.0}
