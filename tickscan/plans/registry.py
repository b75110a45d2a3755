"""Registered queries (Spark) and their DuckDB oracle SQL, keyed by the names of SURVEY section 2.

Every query reads the driver's tables (``events`` read as ticks) and runs over all of it. Output
columns are aliased identically on both sides; timestamps are returned as wall time
(``TIMESTAMP_NTZ``), EMAs are rounded to 6 decimals, integer columns are ``BIGINT``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ticks import (delay_ms, display_value, epoch_ms, from_proto_ts, instant,
                               parse_trade_ts, region_of, topic_name, to_proto_ts, wall_time)
from ..operators import catalog as cat
from ..operators import history as hist
from ..operators.bars import bars
from ..operators.ema import crossovers
from ..operators.clean import ingest_quality, region_job, start_align, valid_ticks
from ..operators.latency import (PERCENTILES, RANK_ERROR, latency_sketches, latency_stats, merge_sketches, message_latency,
                                 route_kind, sketch_percentiles)
from ..operators.latest import last_price, price_direction
from ..schemas import LATENESS_BOUND
from ..session import scratch_path, write_and_read
from ..sources.tables import events_as_ticks, read_table
from . import oracle as O
from .trend import trend

Query = Callable[[SparkSession, str], DataFrame]

START = "2024-01-15 12:00:00"
SHARE = "CLICK.FR"
REGION = "FR"
SPLIT_DAY = "2024-01-16"      # history / live split and first table batch
OVERLAP_DAY = "2024-01-10"    # the live feed and the second table batch start here
BUMP = 1000.0                 # added to values of rows that must lose against stored ones


def _ticks(spark, sf):
    return events_as_ticks(spark, sf)


def _valid(spark, sf):
    return valid_ticks(_ticks(spark, sf))


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


def _long(c):
    return F.col(c).cast("long").alias(c)


def _trend(spark, sf, window="1 hour", spans=(38, 100), offset=None):
    return trend(_ticks(spark, sf), window, spans, offset)


def _ema_out(e, spans=(38, 100)):
    return e.select("symbol", "window_start", "trade_timestamp", *[_r6(f"ema{s}") for s in spans])


def _ema_rows(spark, sf):
    """EMA rows of 1-minute bars (symbol, ema38, ema100, trade_timestamp)."""
    t = _trend(spark, sf, "1 minute")
    return t.emas.select("symbol", _r6("ema38"), _r6("ema100"), "trade_timestamp")


def _stored(spark, rows: DataFrame, writer) -> tuple[DataFrame, DataFrame]:
    """Rows written through a history-table sink into a fresh table: the table (what history queries
    and subscribers read in production) and the sink's side table of latest times."""
    from ..sinks.tables import latest_times
    path = scratch_path(spark, "history-table")
    writer(rows, path)
    return spark.read.parquet(path), latest_times(spark, path)


def _ema_table(spark, sf):
    from ..sinks.tables import write_ema_rows
    return _stored(spark, _ema_rows(spark, sf), write_ema_rows)


def _advisory_table(spark, sf):
    from ..sinks.tables import write_advisories
    rows = _trend(spark, sf, "1 minute").advisories.select("symbol", "trade_timestamp", "message")
    return _stored(spark, rows, write_advisories)


# ---------------------------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------------------------

def q_ticks(spark, sf):
    return _ticks(spark, sf).select("id", "sec_type", "last", "trade_timestamp", "wallclock_timestamp", "delay")


def q_ticks_valid(spark, sf):
    return _valid(spark, sf).select("id", "share", "region", "price", "trade_timestamp")


def q_parse_trade_ts(spark, sf):
    ev = read_table(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        F.date_format("ts", "dd-MM-yyyy").alias("trading_date"),
        F.date_format("ts", "HH:mm:ss.SSSSSS").alias("trading_time"))
    return ev.withColumn("trade_timestamp", wall_time(parse_trade_ts("trading_date", "trading_time")))


def q_tick_region(spark, sf):
    return _valid(spark, sf).select("seq", "id", "share", "region")


def q_tick_delay(spark, sf):
    return _ticks(spark, sf).select("seq", delay_ms("wallclock_timestamp", "trade_timestamp").alias("delay"))


def q_tick_topic(spark, sf):
    return _valid(spark, sf).select("seq", "region", topic_name(F.col("region"), "ticks").alias("topic"))


def q_start_align(spark, sf):
    return start_align(_ticks(spark, sf), START).select("seq", "id", "trade_timestamp")


def q_tick_price(spark, sf):
    return _valid(spark, sf).select("seq", "last", "price")


def q_event_time_ms(spark, sf):
    return _ticks(spark, sf).select("seq", epoch_ms("trade_timestamp").alias("event_time_ms"))


def q_proto_ts(spark, sf):
    t = _ticks(spark, sf).select("seq", "trade_timestamp", to_proto_ts("trade_timestamp").alias("p"))
    return t.select("seq", F.col("p.seconds").alias("seconds"), F.col("p.nanos").cast("long").alias("nanos"),
                    wall_time(from_proto_ts("p")).alias("round_trip"))


def q_region_job(spark, sf):
    return region_job(_valid(spark, sf), REGION).select("seq", "id", "price", "trade_timestamp")


def q_symbol_counts(spark, sf):
    return cat.symbol_counts(_valid(spark, sf))


def q_top_symbols(spark, sf):
    return cat.top_symbols(_valid(spark, sf)).select(_long("rank"), "id", "n")


def q_regions(spark, sf):
    return cat.regions(_valid(spark, sf))


def q_symbols(spark, sf):
    return cat.symbols(_valid(spark, sf))


def q_symbol_total(spark, sf):
    return cat.symbol_total(_valid(spark, sf))


def q_catalog_topics(spark, sf):
    t = cat.catalog_topics(cat.regions(_valid(spark, sf)))
    return t.select("name", "region", "kind", _long("partitions"), _long("replication_factor"))


def q_bars_1m(spark, sf):
    return bars(_valid(spark, sf), "1 minute").drop("w")


def q_bars_1h(spark, sf):
    return bars(_valid(spark, sf), "1 hour").drop("w")


def q_bars_offset(spark, sf):
    return bars(_valid(spark, sf), "1 hour", "15 minutes").drop("w")


def q_ingest_quality(spark, sf):
    return ingest_quality(_ticks(spark, sf))


def q_latency_stats(spark, sf):
    s = latency_stats(_valid(spark, sf), ["region"])
    return s.select("region", *[_long(c) for c in ("n", "min_delay", "max_delay", "p50_delay", "p95_delay", "p99_delay")],
                    "avg_delay")


def _captured(spark, sf) -> DataFrame:
    """Messages of all three kinds with the time at which a reader gets them: a tick when it arrives, an
    EMA or advisory when its 1-hour window can close (its end and the lateness bound)."""
    t = _trend(spark, sf, "1 hour")
    closed = (F.col("window_end") + F.expr(f"INTERVAL {LATENESS_BOUND}")).alias("benchmark_timestamp")
    rows = write_and_read(t.emas.select("symbol", "window_end", "trade_timestamp", "prev_ema38", "prev_ema100", "ema38", "ema100"), "ema-rows")
    adv = crossovers(rows)
    return (_valid(spark, sf).select(topic_name(F.col("region"), "ticks").alias("topic"), "trade_timestamp",
                                     F.col("wallclock_timestamp").alias("benchmark_timestamp"))
            .unionByName(rows.select(topic_name(region_of("symbol"), "ema").alias("topic"), "trade_timestamp", closed))
            .unionByName(adv.select(topic_name(region_of("symbol"), "advisories").alias("topic"), "trade_timestamp", closed)))


def q_latency_by_kind(spark, sf):
    """Latency of ticks, EMA rows and advisories by region and kind, exact."""
    s = latency_stats(message_latency(_captured(spark, sf)), ["region", "kind"])
    return s.select("region", "kind", *[_long(c) for c in ("n", "min_delay", "max_delay", "p50_delay", "p95_delay", "p99_delay")],
                    "avg_delay")


def q_latency_sketch(spark, sf):
    """Percentiles from stored daily sketches merged over all days: whether each is within the stated
    error of its rank among the messages."""
    m = write_and_read(message_latency(_captured(spark, sf)).select("region", "kind", "day", "delay"), "latency")
    stored = write_and_read(latency_sketches(m), "latency-sketches")
    got = sketch_percentiles(merge_sketches(stored)).withColumnsRenamed({"region": "r", "kind": "k"})
    at = m.join(got, (F.col("region") == F.col("r")) & (F.col("kind") == F.col("k")))
    within = []
    for q in PERCENTILES:
        p = F.col(f"p{int(round(q * 100))}_delay")
        low, high = F.count(F.when(F.col("delay") < p, 1)) / F.first("n"), F.count(F.when(F.col("delay") <= p, 1)) / F.first("n")
        within.append(((low - RANK_ERROR <= q) & (high + RANK_ERROR >= q)).alias(f"p{int(round(q * 100))}_within"))
    return at.groupBy("region", "kind").agg(F.first("n").alias("n"), F.max("delay").alias("max_delay"), *within)


DAMAGED = 7  # records whose trade time in milliseconds ends in this digit are cut short by a byte


def q_topic_roundtrip(spark, sf):
    """Messages of all three kinds as binary topic records, some damaged, read back: their fields, and
    the damaged ones as dead letters."""
    from ..functions.wire import to_wire
    from ..sources.kafka import MESSAGE_BY_KIND, decode_kinds, split_decoded
    emas = _trend(spark, sf, "1 hour").emas
    rows = write_and_read(emas.select("symbol", "trade_timestamp", *[f"{p}ema{s}" for p in ("", "prev_") for s in (38, 100)],
                                      "window_start"), "ema-rows")
    at, arrive = instant("trade_timestamp").alias("trade_timestamp"), instant("wallclock_timestamp").alias("wallclock_timestamp")
    frames = {"ticks": _valid(spark, sf).select("id", "sec_type", "last", at, arrive, "delay"),
              "ema": rows.select("symbol", _r6("ema38"), _r6("ema100"), at),
              "advisories": crossovers(rows).select("symbol", at, "message")}
    records = None
    for kind, f in frames.items():
        value = to_wire(F.struct(*f.columns), MESSAGE_BY_KIND[kind])
        r = f.select(F.col(f.columns[0]).cast("binary").alias("key"), value.alias("value"), F.lit(kind).alias("kind"),
                     topic_name(region_of(f.columns[0]), kind).alias("topic"), (epoch_ms("trade_timestamp") % 10 == DAMAGED).alias("cut"))
        records = r if records is None else records.unionByName(r)
    short = F.expr("substring(value, 1, length(value) - 1)")
    records = records.withColumn("value", F.when(F.col("cut"), short).otherwise(F.col("value")))
    texts = {"ticks": ["id", "sec_type", "last"], "ema": ["symbol"], "advisories": ["symbol", "message"]}
    numbers = {"ticks": ["delay"], "ema": ["ema38", "ema100"], "advisories": []}
    out = None
    for kind, decoded in decode_kinds(records).items():
        good, dead = split_decoded(decoded)
        m, key = F.col("msg"), F.col("key").cast("string").alias("key")
        x = [m[c].cast("double") for c in numbers[kind]] + [F.lit(None).cast("double")] * 2
        read = good.select("topic", key, F.concat_ws("|", *[m[c] for c in texts[kind]]).alias("texts"), x[0].alias("x"), x[1].alias("y"),
                           wall_time(m["trade_timestamp"]).alias("trade_timestamp"), F.lit(True).alias("ok"))
        lost = dead.select("topic", key, *[F.lit(None).cast(t).alias(c) for c, t in read.dtypes[2:-1]], F.lit(False).alias("ok"))
        out = read.unionByName(lost) if out is None else out.unionByName(read).unionByName(lost)
    return out


def q_ema(spark, sf):
    return _ema_out(_trend(spark, sf, "1 hour").emas)


def q_ema_scan(spark, sf):
    return _ema_out(_trend(spark, sf, "1 minute").emas)


SPANS_ALT = (5, 20, 60)


def q_ema_spans(spark, sf):
    return _ema_out(_trend(spark, sf, "1 hour", SPANS_ALT).emas, SPANS_ALT)


def q_crossovers(spark, sf):
    return _trend(spark, sf, "1 hour").advisories.select("symbol", "window_start", "trade_timestamp", "message")


def q_last_price(spark, sf):
    return last_price(_valid(spark, sf))


def q_price_direction(spark, sf):
    return price_direction(_valid(spark, sf))


def q_ema_display(spark, sf):
    e = _trend(spark, sf, "1 hour").emas
    return e.select("symbol", "trade_timestamp", display_value("ema38").alias("ema38"),
                    display_value("ema100").alias("ema100"))


def q_subscribe_share(spark, sf):
    return hist._for_share(_ema_table(spark, sf)[0], SHARE).drop("trade_date")


def q_subscribe_all(spark, sf):
    return hist._for_share(_ema_table(spark, sf)[0], "ALL").drop("trade_date")


def q_route_kind(spark, sf):
    t = _trend(spark, sf, "1 minute")
    v = _valid(spark, sf)
    emas = write_and_read(t.emas.select("symbol", "ema38", "ema100", "prev_ema38", "prev_ema100"), "ema-rows")
    region_of_symbol = region_of("symbol")
    msgs = (v.select(topic_name(F.col("region"), "ticks").alias("topic"))
             .unionByName(emas.select(topic_name(region_of_symbol, "ema").alias("topic")))
             .unionByName(crossovers(emas).select(topic_name(region_of_symbol, "advisories").alias("topic"))))
    return route_kind(msgs).groupBy("topic", "kind").agg(F.count(F.lit(1)).alias("n"))


def q_ema_latest(spark, sf):
    table, times = _ema_table(spark, sf)
    return hist.latest(table, times=times).drop("trade_date")


def q_ema_history(spark, sf):
    table, times = _ema_table(spark, sf)
    return hist.ema_history(table, times=times)


def q_advisory_history(spark, sf):
    table, times = _advisory_table(spark, sf)
    return hist.advisory_history(table, times=times)


def q_ema_viewport(spark, sf):
    table, times = _ema_table(spark, sf)
    return hist.viewport(table, times=times).drop("trade_date")


def q_ema_viewport_shifted(spark, sf):
    """The view port moved one step (15 minutes) back, as the chart's navigation does."""
    table, times = _ema_table(spark, sf)
    return hist.viewport(table, shift_minutes=-15, times=times).drop("trade_date")


def q_time_grid(spark, sf):
    table, times = _ema_table(spark, sf)
    return hist.time_grid(table, times=times)


def _bumped(rows: DataFrame) -> DataFrame:
    """The rows with other EMA values, to tell which of two rows with one key was kept."""
    return rows.withColumns({c: F.round(F.col(c) + F.lit(BUMP), 6) for c in ("ema38", "ema100") if c in rows.columns})


def q_history_plus_live(spark, sf):
    """The live feed overlaps the history with other values: where both have a row, the stored one stays."""
    e = write_and_read(_ema_rows(spark, sf), "ema-rows")
    old = e.where(F.col("trade_timestamp") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    live = _bumped(e.where(F.col("trade_timestamp") >= F.lit(OVERLAP_DAY).cast("timestamp_ntz")))
    return hist.history_plus_live(old, live)


def _upsert_replay(spark, sf, rows: DataFrame, writer, later) -> DataFrame:
    """Three writes into a fresh table: an early part, a later part that overlaps it with other values
    (``later``), and a full replay. The first writer of a key must win."""
    path = scratch_path(spark, "history-table")
    rows = write_and_read(rows, "table-rows")
    ts = F.col("trade_timestamp")
    writer(rows.where(ts < F.lit(SPLIT_DAY).cast("timestamp_ntz")), path)
    writer(later(rows.where(ts >= F.lit(OVERLAP_DAY).cast("timestamp_ntz"))), path)
    writer(rows, path)
    return spark.read.parquet(path)


def q_ema_upsert_ignore(spark, sf):
    from ..sinks.tables import write_ema_rows
    t = _upsert_replay(spark, sf, _ema_rows(spark, sf), write_ema_rows, _bumped)
    return t.select("symbol", "ema38", "ema100", "trade_timestamp", F.col("trade_date").cast("string").alias("trade_date"))


def q_advisory_upsert_ignore(spark, sf):
    from ..sinks.tables import write_advisories
    rows = _trend(spark, sf, "1 minute").advisories.select("symbol", "trade_timestamp", "message")
    t = _upsert_replay(spark, sf, rows, write_advisories,
                       lambda r: r.withColumn("message", F.concat("message", F.lit("?"))))
    return t.select("symbol", "advice", "trade_timestamp", F.col("trade_date").cast("string").alias("trade_date"))


def q_split_roundtrip(spark, sf):
    """Ticks written as per-symbol CSV files (split by region and symbol, with header) and read back
    by header name; the valid ticks that come back."""
    from ..sinks.files import split_by_symbol, to_raw_rows
    from ..sources.dayfile import read_symbol_files
    path = scratch_path(spark, "split")
    split_by_symbol(to_raw_rows(_ticks(spark, sf)), path, by_region=True)
    back = valid_ticks(read_symbol_files(spark, path).ticks)
    return back.select("id", "region", "last", "price", wall_time("trade_timestamp").alias("trade_timestamp"))


# Fixed content of the day files written for ``day_files_roundtrip`` (text before the header and
# the column descriptions; the scan must skip both).
DAY_FILE_PREAMBLE = [f"Exchange day report, line {i + 1}, generated, not data" for i in range(11)]
DAY_FILE_DESCRIPTION = {"ID": "Instrument id, share.region", "Last": "Last price, as text",
                        "Trading date": "Date, dd-MM-yyyy", "Trading time": "Time, HH:mm:ss.ffffff"}
DAY_FILE_ORDERS = {"FR": ["Trading time", "Last", "Extra", "ID", "Trading date", "SecType"]}


def q_day_files_roundtrip(spark, sf):
    """Ticks written as raw exchange day files (one per region and day: 11 preamble lines, header,
    description line; one region with another column order), read back by the day-file scan."""
    from ..sinks.files import to_raw_rows, write_day_files
    from ..sources.dayfile import read_day_files
    path = scratch_path(spark, "dayfiles")
    write_day_files(to_raw_rows(_ticks(spark, sf)), path, DAY_FILE_PREAMBLE, DAY_FILE_DESCRIPTION, DAY_FILE_ORDERS)
    back = read_day_files(spark, path, path_glob="*.txt")
    return (valid_ticks(back.ticks)
            .select("id", "region", "last", "price", wall_time("trade_timestamp").alias("trade_timestamp")))


QUOTED_SPLIT_BYTES = 2048


def q_day_files_quoted(spark, sf):
    """Day files whose ignored column holds line ends, commas and quotes, read in splits of 2 KB, most of
    which start inside a record."""
    from ..sinks.files import to_raw_rows, write_day_files
    from ..sources.dayfile import read_day_files
    path = scratch_path(spark, "dayfiles")
    time = F.col("Trading time")
    note = (F.when(F.crc32(time.cast("binary")) % 3 == 0, F.concat(F.lit('two\nlines, "of" '), time, F.lit("\r\n")))
            .when(F.crc32(time.cast("binary")) % 3 == 1, F.concat(F.lit('5" x'), time)).otherwise(F.lit("x")))
    write_day_files(to_raw_rows(_ticks(spark, sf)), path, DAY_FILE_PREAMBLE, DAY_FILE_DESCRIPTION, DAY_FILE_ORDERS, note)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(QUOTED_SPLIT_BYTES))
    try:  # the body is scanned here
        back = read_day_files(spark, path, path_glob="*.txt")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    return (valid_ticks(back.ticks)
            .select("id", "region", "last", "price", wall_time("trade_timestamp").alias("trade_timestamp")))


def _li(spark, sf):
    from ..sources.tables import lineitem_as_ticks
    return lineitem_as_ticks(spark, sf)


def q_li_bars_1d(spark, sf):
    """lineitem as ticks (1,500 symbols, many ticks per day, struct tie-break) -> daily bars."""
    return bars(valid_ticks(_li(spark, sf)), "1 day").drop("w")


def q_li_ema_1d(spark, sf):
    return _ema_out(trend(_li(spark, sf), "1 day").emas)


def q_li_crossovers_7d(spark, sf):
    return trend(_li(spark, sf), "7 days").advisories.select("symbol", "window_start", "trade_timestamp", "message")


# Price paths laid over the events feed: every tick of every event goes to each of these symbols, so
# each has the feed's whole history of 1-minute bars.
FLAT_PRICES = {"FLAT100.FR": "100.0", "FLAT1037.FR": "10.37", "FLAT173.NL": "17.3", "PENNY.ETR": "0.01"}
STEP_TICKS = 500  # ticks between two steps


def _path_ticks(spark, sf, paths: dict[str, str]) -> DataFrame:
    """The events feed with its ids and prices replaced: one copy for each id, priced by a SQL expression."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("id"), F.expr(f"CAST({p} AS STRING)").alias("last")) for i, p in paths.items()]))
    t = _ticks(spark, sf).withColumn("_path", each)
    return t.withColumns({"id": F.col("_path.id"), "last": F.col("_path.last")}).drop("_path")


# Steps by arrival number: levels of round prices, and pennies up and down.
STEP_PRICES = {"STEPS.FR": f"100.0D + 5 * ((seq div {STEP_TICKS}) % 4)", "PENNIES.NL": f"10.0D + 0.01D * ((seq div {STEP_TICKS}) % 2)"}
STEP_PRICES_SQL = {"STEPS.FR": f"100.0::DOUBLE + 5 * ((seq // {STEP_TICKS}) % 4)",
                   "PENNIES.NL": f"10.0::DOUBLE + 0.01::DOUBLE * ((seq // {STEP_TICKS}) % 2)"}


def _path_crossovers(spark, sf, paths):
    t = trend(_path_ticks(spark, sf, paths), "1 minute")
    return t.advisories.select("symbol", "window_start", "trade_timestamp", "message")


def q_crossovers_flat(spark, sf):
    """Advisories of symbols whose price never moves: the first bar's only, however long the history."""
    return _path_crossovers(spark, sf, FLAT_PRICES)


def q_crossovers_steps(spark, sf):
    """Advisories of prices that stand still for hundreds of bars between steps."""
    return _path_crossovers(spark, sf, STEP_PRICES)


def q_bars_null_seq(spark, sf):
    """1-hour bars where every third tick has no arrival number: it orders before the others."""
    t = _valid(spark, sf).withColumn("trade_timestamp", F.date_trunc("hour", "trade_timestamp").cast("timestamp_ntz"))
    t = t.withColumn("seq", F.when(F.col("seq") % 3 != 0, F.col("seq")))
    b = bars(t, "1 hour")
    only = t.groupBy(F.col("id").alias("symbol"), F.col("trade_timestamp").alias("window_start")).agg(F.count("seq").alias("n_seq"))
    return b.join(only.where("n_seq > 0"), ["symbol", "window_start"]).select("symbol", "window_start", "close", "ticks")


QUERIES: dict[str, Query] = {
    "crossovers_flat": q_crossovers_flat,
    "crossovers_steps": q_crossovers_steps,
    "bars_null_seq": q_bars_null_seq,
    "ticks": q_ticks,
    "ticks_valid": q_ticks_valid,
    "parse_trade_ts": q_parse_trade_ts,
    "tick_region": q_tick_region,
    "tick_delay": q_tick_delay,
    "tick_topic": q_tick_topic,
    "start_align": q_start_align,
    "tick_price": q_tick_price,
    "event_time_ms": q_event_time_ms,
    "proto_ts": q_proto_ts,
    "region_job": q_region_job,
    "symbol_counts": q_symbol_counts,
    "top_symbols": q_top_symbols,
    "regions": q_regions,
    "symbols": q_symbols,
    "symbol_total": q_symbol_total,
    "catalog_topics": q_catalog_topics,
    "bars_1m": q_bars_1m,
    "bars_1h": q_bars_1h,
    "bars_offset": q_bars_offset,
    "ingest_quality": q_ingest_quality,
    "latency_stats": q_latency_stats,
    "latency_by_kind": q_latency_by_kind,
    "latency_sketch": q_latency_sketch,
    "topic_roundtrip": q_topic_roundtrip,
    "ema": q_ema,
    "ema_scan": q_ema_scan,
    "ema_spans": q_ema_spans,
    "crossovers": q_crossovers,
    "last_price": q_last_price,
    "price_direction": q_price_direction,
    "ema_display": q_ema_display,
    "subscribe_share": q_subscribe_share,
    "subscribe_all": q_subscribe_all,
    "route_kind": q_route_kind,
    "ema_latest": q_ema_latest,
    "ema_history": q_ema_history,
    "advisory_history": q_advisory_history,
    "ema_viewport": q_ema_viewport,
    "ema_viewport_shifted": q_ema_viewport_shifted,
    "time_grid": q_time_grid,
    "history_plus_live": q_history_plus_live,
    "ema_upsert_ignore": q_ema_upsert_ignore,
    "advisory_upsert_ignore": q_advisory_upsert_ignore,
    "split_roundtrip": q_split_roundtrip,
    "day_files_roundtrip": q_day_files_roundtrip,
    "day_files_quoted": q_day_files_quoted,
    "li_bars_1d": q_li_bars_1d,
    "li_ema_1d": q_li_ema_1d,
    "li_crossovers_7d": q_li_crossovers_7d,
}


# ---------------------------------------------------------------------------------------------
# Oracle side (DuckDB)
# ---------------------------------------------------------------------------------------------

def _ema_select(spans=(38, 100)):
    return "SELECT symbol, window_start, trade_timestamp, " + ", ".join(f"round(e{s}, 6) AS ema{s}" for s in spans) + " FROM emas"


_EMA_TABLE = "SELECT symbol, round(e38, 6) AS ema38, round(e100, 6) AS ema100, trade_timestamp FROM emas"
_ADV_TABLE = "SELECT symbol, message AS advice, trade_timestamp FROM advs"
_LATER = f"trade_timestamp >= TIMESTAMP '{SPLIT_DAY}'"
_KEPT_EMA = ("symbol, " + ", ".join(f"CASE WHEN {_LATER} THEN round({c} + {BUMP}, 6) ELSE {c} END AS {c}" for c in ("ema38", "ema100"))
             + ", trade_timestamp")
_M1 = O.trend_with("1 minute")
_H1 = O.trend_with("1 hour")


def _latency_sql():
    return O.with_base("""h AS (SELECT region, delay, count(*) AS c FROM vticks GROUP BY 1, 2)""",
                       """hc AS (SELECT region, delay, c,
                 sum(c) OVER (PARTITION BY region ORDER BY delay ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
                 sum(c) OVER (PARTITION BY region) AS n FROM h)""") + """
SELECT region, CAST(any_value(n) AS BIGINT) AS n, CAST(min(delay) AS BIGINT) AS min_delay,
       CAST(max(delay) AS BIGINT) AS max_delay,
       CAST(min(delay) FILTER (WHERE cum >= ceil(0.5 * n)) AS BIGINT) AS p50_delay,
       CAST(min(delay) FILTER (WHERE cum >= ceil(0.95 * n)) AS BIGINT) AS p95_delay,
       CAST(min(delay) FILTER (WHERE cum >= ceil(0.99 * n)) AS BIGINT) AS p99_delay,
       round(sum(delay * c) / any_value(n), 6) AS avg_delay
FROM hc GROUP BY region"""


_CAPTURED = """, messages AS (
  SELECT region, 'ticks' AS kind, trade_timestamp, wallclock_timestamp AS arrival FROM vticks
  UNION ALL SELECT split_part(symbol, '.', 2), 'ema', trade_timestamp, window_end + INTERVAL 10 SECOND FROM emas
  UNION ALL SELECT split_part(symbol, '.', 2), 'advisories', trade_timestamp, window_end + INTERVAL 10 SECOND FROM advs),
lat AS (SELECT region, kind, epoch_us(arrival) // 1000 - epoch_us(trade_timestamp) // 1000 AS delay FROM messages)"""


def _latency_kind_sql():
    return _H1 + _CAPTURED + """, h AS (SELECT region, kind, delay, count(*) AS c FROM lat GROUP BY 1, 2, 3),
hc AS (SELECT region, kind, delay, c, sum(c) OVER (PARTITION BY region, kind ORDER BY delay ROWS UNBOUNDED PRECEDING) AS cum,
              sum(c) OVER (PARTITION BY region, kind) AS n FROM h)
SELECT region, kind, CAST(any_value(n) AS BIGINT) AS n, CAST(min(delay) AS BIGINT) AS min_delay, CAST(max(delay) AS BIGINT) AS max_delay,
       CAST(min(delay) FILTER (WHERE cum >= ceil(0.5 * n)) AS BIGINT) AS p50_delay,
       CAST(min(delay) FILTER (WHERE cum >= ceil(0.95 * n)) AS BIGINT) AS p95_delay,
       CAST(min(delay) FILTER (WHERE cum >= ceil(0.99 * n)) AS BIGINT) AS p99_delay,
       round(sum(delay * c) / any_value(n), 6) AS avg_delay
FROM hc GROUP BY region, kind"""


_TOPIC_SQL = _H1 + f""", m AS (
  SELECT region || '-ticks' AS topic, id AS key, id || '|' || sec_type || '|' || last AS texts, CAST(delay AS DOUBLE) AS x, NULL::DOUBLE AS y, trade_timestamp FROM vticks
  UNION ALL SELECT split_part(symbol, '.', 2) || '-ema', symbol, symbol, round(e38, 6), round(e100, 6), trade_timestamp FROM emas
  UNION ALL SELECT split_part(symbol, '.', 2) || '-advisories', symbol, symbol || '|' || message, NULL, NULL, trade_timestamp FROM advs),
k AS (SELECT *, epoch_us(trade_timestamp) // 1000 % 10 <> {DAMAGED} AS ok FROM m)
SELECT topic, key, CASE WHEN ok THEN texts END AS texts, CASE WHEN ok THEN x END AS x, CASE WHEN ok THEN y END AS y,
       CASE WHEN ok THEN trade_timestamp END AS trade_timestamp, ok FROM k"""


def _history_sql(table_sql: str, select: str) -> str:
    return _M1 + f""", tbl AS ({table_sql}), lt AS (SELECT symbol, max(trade_timestamp) AS latest FROM tbl GROUP BY symbol)
SELECT {select} FROM tbl JOIN lt USING (symbol)
WHERE tbl.trade_timestamp BETWEEN lt.latest - INTERVAL 100 MINUTE AND lt.latest"""


def _view(shift_minutes: int = 0) -> str:
    return """, tbl AS (""" + _EMA_TABLE + f"""),
vb AS (SELECT symbol, max(trade_timestamp) - INTERVAL 15 MINUTE + INTERVAL ({shift_minutes}) MINUTE AS view_start,
              max(trade_timestamp) - INTERVAL 15 MINUTE + INTERVAL ({shift_minutes}) MINUTE + INTERVAL 60 MINUTE AS view_end
       FROM tbl GROUP BY symbol)"""


_VIEW = _view(0)
_VIEW_SELECT = """
SELECT tbl.symbol, tbl.ema38, tbl.ema100, tbl.trade_timestamp, vb.view_start, vb.view_end
FROM tbl JOIN vb USING (symbol) WHERE tbl.trade_timestamp BETWEEN vb.view_start AND vb.view_end"""


def _path_sql(paths: dict[str, str]) -> str:
    """Recursive trend over the events feed copied to each id, with the price a SQL expression."""
    ticks = " UNION ALL ".join(f"SELECT '{i}' AS id, CAST({p} AS DOUBLE) AS price, ts AS trade_timestamp, seq FROM ev" for i, p in paths.items())
    base = f"ev AS (SELECT ts, event_id AS seq FROM events WHERE value IS NOT NULL),\nvticks AS ({ticks})"
    return O.trend_with("1 minute", base=base) + "SELECT symbol, window_start, trade_timestamp, message FROM advs"


ORACLE: dict[str, str] = {
    "crossovers_flat": _path_sql(FLAT_PRICES),
    "crossovers_steps": _path_sql(STEP_PRICES_SQL),
    "bars_null_seq": O.with_base() + """SELECT id AS symbol, date_trunc('hour', trade_timestamp) AS window_start,
       arg_max(price, CASE WHEN seq % 3 <> 0 THEN seq ELSE -1 END) AS close, count(*) AS ticks
FROM vticks GROUP BY 1, 2 HAVING count(*) FILTER (WHERE seq % 3 <> 0) > 0""",
    "ticks": O.with_base() + "SELECT id, sec_type, last, trade_timestamp, wallclock_timestamp, delay FROM ticks",
    "ticks_valid": O.with_base() + "SELECT id, share, region, price, trade_timestamp FROM vticks",
    "parse_trade_ts": """SELECT seq, trading_date, trading_time,
       strptime(trading_date || ' ' || trading_time, '%d-%m-%Y %H:%M:%S.%f') AS trade_timestamp
FROM (SELECT event_id AS seq, strftime(ts, '%d-%m-%Y') AS trading_date, strftime(ts, '%H:%M:%S.%f') AS trading_time
      FROM events)""",
    "tick_region": O.with_base() + "SELECT seq, id, share, region FROM vticks",
    "tick_delay": O.with_base() + "SELECT seq, delay FROM ticks",
    "tick_topic": O.with_base() + "SELECT seq, region, region || '-ticks' AS topic FROM vticks",
    "start_align": O.with_base() + f"SELECT seq, id, trade_timestamp FROM ticks WHERE trade_timestamp > TIMESTAMP '{START}'",
    "tick_price": O.with_base() + "SELECT seq, last, price FROM vticks",
    "event_time_ms": O.with_base() + "SELECT seq, epoch_us(trade_timestamp) // 1000 AS event_time_ms FROM ticks",
    "proto_ts": O.with_base() + """SELECT seq, CAST(floor(epoch_us(trade_timestamp) / 1000000) AS BIGINT) AS seconds,
       CAST((epoch_us(trade_timestamp) % 1000000 + 1000000) % 1000000 * 1000 AS BIGINT) AS nanos,
       trade_timestamp AS round_trip FROM ticks""",
    "region_job": O.with_base() + f"SELECT seq, id, price, trade_timestamp FROM vticks WHERE region = '{REGION}'",
    "symbol_counts": O.with_base() + "SELECT id, count(*) AS n FROM vticks GROUP BY id",
    "top_symbols": O.with_base() + """SELECT row_number() OVER (ORDER BY n DESC, id ASC) AS rank, id, n
FROM (SELECT id, count(*) AS n FROM vticks GROUP BY id) ORDER BY n DESC, id LIMIT 10""",
    "regions": O.with_base() + "SELECT DISTINCT region FROM vticks",
    "symbols": O.with_base() + "SELECT DISTINCT id AS symbol FROM vticks",
    "symbol_total": O.with_base() + "SELECT count(DISTINCT id) AS n_symbols FROM vticks",
    "catalog_topics": O.with_base() + """SELECT r.region || '-' || k.kind AS name, r.region, k.kind,
       CAST(k.partitions AS BIGINT) AS partitions, CAST(1 AS BIGINT) AS replication_factor
FROM (SELECT DISTINCT region FROM vticks) r,
     (VALUES ('ticks', 10), ('ema', 1), ('advisories', 1)) k(kind, partitions)""",
    "bars_1m": O.with_base(O.bars_cte("1 minute")) + "SELECT * FROM bars",
    "bars_1h": O.with_base(O.bars_cte("1 hour")) + "SELECT * FROM bars",
    "bars_offset": O.with_base(O.bars_cte("1 hour", "15 minutes")) + "SELECT * FROM bars",
    "ingest_quality": O.with_base("""chk AS (
  SELECT nullif(split_part(id, '.', 2), '') AS region,
         CASE WHEN nullif(split_part(id, '.', 2), '') IS NULL OR nullif(split_part(id, '.', 1), '') IS NULL THEN 'bad_id'
              WHEN trade_timestamp IS NULL THEN 'bad_timestamp'
              WHEN TRY_CAST(last AS DOUBLE) IS NULL THEN 'bad_price' END AS reason
  FROM ticks)""") + """SELECT region, count(*) FILTER (WHERE reason IS NULL) AS sent,
       count(*) FILTER (WHERE reason IS NOT NULL) AS skipped,
       count(*) FILTER (WHERE reason = 'bad_id') AS bad_id,
       count(*) FILTER (WHERE reason = 'bad_timestamp') AS bad_timestamp,
       count(*) FILTER (WHERE reason = 'bad_price') AS bad_price
FROM chk GROUP BY region""",
    "latency_stats": _latency_sql(),
    "latency_by_kind": _latency_kind_sql(),
    "latency_sketch": _H1 + _CAPTURED + """
SELECT region, kind, count(*) AS n, max(delay) AS max_delay, true AS p50_within, true AS p95_within, true AS p99_within
FROM lat GROUP BY 1, 2""",
    "topic_roundtrip": _TOPIC_SQL,
    "ema": _H1 + _ema_select(),
    "ema_scan": _M1 + _ema_select(),
    "ema_spans": O.trend_with("1 hour", SPANS_ALT) + _ema_select(SPANS_ALT),
    "crossovers": _H1 + "SELECT symbol, window_start, trade_timestamp, message FROM advs",
    "last_price": O.with_base() + """SELECT id AS symbol, arg_max(price, (trade_timestamp, seq)) AS last_price,
       max(trade_timestamp) AS trade_timestamp FROM vticks GROUP BY id""",
    "price_direction": O.with_base("""r AS (SELECT id, price, row_number() OVER (PARTITION BY id ORDER BY trade_timestamp DESC, seq DESC) AS rn
  FROM vticks)""") + """SELECT id AS symbol, max(price) FILTER (WHERE rn = 1) AS last_price,
       max(price) FILTER (WHERE rn = 2) AS previous_price,
       CASE WHEN count(*) FILTER (WHERE rn <= 2) < 2 THEN 'single'
            WHEN max(price) FILTER (WHERE rn = 1) > max(price) FILTER (WHERE rn = 2) THEN 'up'
            WHEN max(price) FILTER (WHERE rn = 1) < max(price) FILTER (WHERE rn = 2) THEN 'down'
            ELSE 'flat' END AS direction
FROM r GROUP BY id""",
    "ema_display": _H1 + "SELECT symbol, trade_timestamp, round(e38, 2) AS ema38, round(e100, 2) AS ema100 FROM emas",
    "subscribe_share": _M1 + f"SELECT * FROM ({_EMA_TABLE}) WHERE symbol = '{SHARE}'",
    "subscribe_all": _M1 + f"SELECT * FROM ({_EMA_TABLE})",
    "route_kind": _M1 + """, msgs AS (
  SELECT region || '-ticks' AS topic FROM vticks
  UNION ALL SELECT split_part(symbol, '.', 2) || '-ema' FROM emas
  UNION ALL SELECT split_part(symbol, '.', 2) || '-advisories' FROM advs)
SELECT topic, CASE WHEN contains(topic, '-ticks') THEN 'ticks' WHEN contains(topic, '-ema') THEN 'ema'
                   WHEN contains(topic, '-advisories') THEN 'advisories' ELSE 'unknown' END AS kind,
       count(*) AS n FROM msgs GROUP BY 1, 2""",
    "ema_latest": _M1 + f""", tbl AS ({_EMA_TABLE})
SELECT symbol, arg_max(ema38, trade_timestamp) AS ema38, arg_max(ema100, trade_timestamp) AS ema100,
       max(trade_timestamp) AS trade_timestamp FROM tbl GROUP BY symbol""",
    "ema_history": _history_sql(_EMA_TABLE, "tbl.symbol, tbl.ema38, tbl.ema100, tbl.trade_timestamp"),
    "advisory_history": _history_sql(_ADV_TABLE, """tbl.symbol, tbl.advice AS message, tbl.trade_timestamp,
       strftime(tbl.trade_timestamp, '%H:%M:%S') AS clock,
       CASE WHEN tbl.advice = 'Buy!' THEN 1 WHEN tbl.advice = 'Sell!' THEN -1 ELSE 0 END AS flag"""),
    "ema_viewport": _M1 + _VIEW + _VIEW_SELECT,
    "ema_viewport_shifted": _M1 + _view(-15) + _VIEW_SELECT,
    "time_grid": _M1 + _VIEW + """
SELECT symbol, unnest(generate_series(view_start, view_end, INTERVAL 5 MINUTE)) AS grid_time FROM vb""",
    "history_plus_live": _M1 + f"SELECT {_KEPT_EMA} FROM ({_EMA_TABLE})",
    "split_roundtrip": O.with_base() + "SELECT id, region, last, price, trade_timestamp FROM vticks",
    "day_files_quoted": O.with_base() + "SELECT id, region, last, price, trade_timestamp FROM vticks",
    "day_files_roundtrip": O.with_base() + "SELECT id, region, last, price, trade_timestamp FROM vticks",
    "li_bars_1d": "WITH " + O.LI_BASE + ",\n" + O.bars_cte("1 day") + "\nSELECT * FROM bars",
    "li_ema_1d": O.trend_with("1 day", base=O.LI_BASE) + _ema_select(),
    "li_crossovers_7d": O.trend_with("7 days", base=O.LI_BASE) + "SELECT symbol, window_start, trade_timestamp, message FROM advs",
    "ema_upsert_ignore": _M1 + f"SELECT {_KEPT_EMA}, CAST(CAST(trade_timestamp AS DATE) AS VARCHAR) AS trade_date FROM ({_EMA_TABLE})",
    "advisory_upsert_ignore": _M1 + f"SELECT symbol, CASE WHEN {_LATER} THEN advice || '?' ELSE advice END AS advice, trade_timestamp, CAST(CAST(trade_timestamp AS DATE) AS VARCHAR) AS trade_date FROM ({_ADV_TABLE})",
}


def _prepared(q: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        from ..session import prepare
        return q(prepare(spark), sf)
    run.__name__ = q.__name__
    run.__doc__ = q.__doc__
    return run


def all_queries() -> dict[str, Query]:
    from ..streaming.registry import STREAM_QUERIES
    return {k: _prepared(v) for k, v in (QUERIES | STREAM_QUERIES).items()}


def all_oracles() -> dict[str, str]:
    from ..streaming.registry import STREAM_ORACLE, stream_oracle
    return ORACLE | STREAM_ORACLE | stream_oracle(ORACLE["price_direction"], _KEPT_EMA, _EMA_TABLE, SHARE)
