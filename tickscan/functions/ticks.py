"""Scalar column expressions over ticks (all JVM-side built-ins, no Python per row).

Every function takes and returns ``Column``s so it can sit in any ``select``/``where`` and stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BUY, RAW_TIMESTAMP_FORMAT, SELL


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(ts) -> Column:
    """An instant (``TIMESTAMP``) from either timestamp flavour; NTZ is read as UTC wall time."""
    return _c(ts).cast("timestamp")


def wall_time(ts) -> Column:
    """The UTC wall time (``TIMESTAMP_NTZ``) of an instant; the form used in query results."""
    return _c(ts).cast("timestamp_ntz")


def parse_trade_ts(date_col, time_col) -> Column:
    """``dd-MM-yyyy`` date and ``HH:mm:ss[.fraction]`` time (UTC) to a timestamp; NULL if unparsable."""
    return F.try_to_timestamp(F.concat_ws(" ", F.trim(_c(date_col)), F.trim(_c(time_col))),
                              F.lit(RAW_TIMESTAMP_FORMAT))


def share_of(id_col) -> Column:
    """First ``.``-separated token of a tick id (``AAA`` of ``AAA.FR``); NULL when empty."""
    return F.nullif(F.substring_index(_c(id_col), ".", 1), F.lit(""))


def region_of(id_col) -> Column:
    """Second ``.``-separated token of a tick id (``FR`` of ``AAA.FR``, ``B`` of ``A.B.C``); NULL when
    there is no ``.`` or the token is empty. Plain substring search, no regex per row."""
    i = _c(id_col)
    second = F.substring_index(F.substring_index(i, ".", 2), ".", -1)
    return F.when(F.instr(i, ".") > 0, F.nullif(second, F.lit("")))


def delay_ms(wallclock, trade) -> Column:
    """Milliseconds from trade time to wall-clock time, each truncated to whole milliseconds."""
    return F.unix_millis(instant(wallclock)) - F.unix_millis(instant(trade))


def topic_name(region, kind) -> Column:
    """Topic of a region and kind, ``<region>-<kind>``."""
    kind = F.lit(kind) if isinstance(kind, str) and kind in ("ticks", "ema", "advisories") else _c(kind)
    return F.concat_ws("-", _c(region), kind)


def price_of(last) -> Column:
    """Price text to double; NULL (quarantined later) instead of a failure for bad text."""
    return _c(last).try_cast("double")


def whole_units(us: Column, size: int) -> Column:
    """``floor(us / size)`` in whole numbers (a double quotient is exact only below 2**53)."""
    return F.call_function("div", us - F.pmod(us, F.lit(size)), F.lit(size).cast("long"))


def epoch_ms(ts) -> Column:
    return F.unix_millis(instant(ts))


def to_proto_ts(ts) -> Column:
    """Timestamp to ``{seconds, nanos}``; nanos stay non-negative for instants before 1970."""
    us = F.unix_micros(instant(ts))
    return F.struct(whole_units(us, 1_000_000).alias("seconds"),
                    (F.pmod(us, F.lit(1_000_000)) * 1000).cast("int").alias("nanos"))


def from_proto_ts(proto) -> Column:
    p = _c(proto)
    return F.timestamp_micros(p["seconds"] * 1_000_000 + whole_units(p["nanos"].cast("long"), 1000))


def clock_label(ts) -> Column:
    """``HH:mm:ss`` in UTC."""
    return F.date_format(instant(ts), "HH:mm:ss")


def display_value(x, digits: int = 2) -> Column:
    return F.round(_c(x), digits)


def advice_flag(message) -> Column:
    """+1 for a buy advisory, -1 for a sell advisory, 0 otherwise."""
    m = _c(message)
    return F.when(m == BUY, 1).when(m == SELL, -1).otherwise(0)


def topic_kind(topic) -> Column:
    """Kind of a topic name: ``ticks``, ``ema``, ``advisories`` or ``unknown``."""
    t = _c(topic)
    return (F.when(t.contains("-ticks"), "ticks")
             .when(t.contains("-ema"), "ema")
             .when(t.contains("-advisories"), "advisories")
             .otherwise("unknown"))
