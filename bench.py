"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full through the ``noop`` sink (no collect to the driver). One warm-up
pass, then ``$BENCH_REPEAT`` timed passes; the per-query value is the median, ``value`` their sum,
``spread`` the least and largest of each.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from tickscan.operators import history as hist  # noqa: E402
from tickscan.plans import registry as R  # noqa: E402
from tickscan.session import get_session  # noqa: E402
from tickscan.streaming import registry as stream  # noqa: E402


_TABLES: dict = {}


def ema_table_write(spark, sf):
    """The 1-minute EMA rows written through the insert-if-absent sink into a fresh table, read back."""
    _TABLES[sf] = R._ema_table(spark, sf)
    return _TABLES[sf][0]


def ema_history_all(spark, sf):
    """History look-back of every symbol over the table that ``ema_table_write`` stored: the read only."""
    table, times = _TABLES[sf]
    return hist.ema_history(table, times=times)


def stream_bars(spark, sf):
    """The events feed replayed through the streaming bars, a new run each time."""
    stream._RUNS.clear()
    return stream.q_stream_bars(spark, sf)


BENCH = {
    "bars_1m": R.q_bars_1m,
    "ema_scan": R.q_ema_scan,
    "crossovers": R.q_crossovers,
    "ema_table_write": ema_table_write,
    "ema_history": ema_history_all,
    "top_symbols": R.q_top_symbols,
    "latency_stats": R.q_latency_stats,
    "li_bars_1d": R.q_li_bars_1d,
    "li_ema_1d": R.q_li_ema_1d,
    "li_crossovers_7d": R.q_li_crossovers_7d,
    "stream_bars": stream_bars,
}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", cpus,
                        extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    times: dict[str, list[float]] = {k: [] for k in BENCH}
    for rnd in range(repeat + 1):
        for name, q in BENCH.items():
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if rnd > 0:
                times[name].append(dt)
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    spread = {k: [round(min(v), 3), round(max(v), 3)] for k, v in times.items()}
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(med.values()), 3), "unit": "sec",
                      "queries": med, "spread": spread, "sf": sf, "cpus": cpus, "repeat": repeat}))


if __name__ == "__main__":
    main()
