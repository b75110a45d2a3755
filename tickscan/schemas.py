"""Record layouts and the fixed values the results depend on."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values (must stay as they are for results to match the reference system's behaviour).
# ---------------------------------------------------------------------------------------------
# Regions, in the order of the shared region list.
REGIONS = ["ETR", "FR", "NL"]
# Topic kinds and their partition counts, per region.
TOPIC_KINDS = [("ticks", 10), ("ema", 1), ("advisories", 1)]
TOPIC_REPLICATION = 1
# Advisory messages.
BUY = "Buy!"
SELL = "Sell!"
# EMA spans of the analytics job; smoothing factor alpha = 2 / (span + 1); start value 0.
DEFAULT_SPANS = (38, 100)
# Event-time window of the analytics job and the out-of-orderness bound of its watermark.
DEFAULT_WINDOW = "1 minute"
LATENESS_BOUND = "10 seconds"
# Raw exchange day file: lines before the header, and the row after it that describes the columns.
RAW_PREAMBLE_LINES = 11
RAW_REQUIRED_COLUMNS = ["ID", "SecType", "Last", "Trading date", "Trading time"]
RAW_TIMESTAMP_FORMAT = "dd-MM-yyyy HH:mm:ss[.SSSSSSSSS]"
# A tick id is usable when both its share token (before the first ".") and its region token
# (after it) are non-empty.
VALID_ID_PATTERN = r"^[^.]+\.[^.]"
# History look-back in minutes and the chart view port.
HISTORY_LOOKBACK_MINUTES = 100
VIEWPORT_LEAD_MINUTES = 15
VIEWPORT_SPAN_MINUTES = 60
VIEWPORT_GRID_MINUTES = 5
# ---------------------------------------------------------------------------------------------

TICK = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("sec_type", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("trade_timestamp", T.TimestampType()),
    T.StructField("wallclock_timestamp", T.TimestampType()),
    T.StructField("delay", T.LongType()),
])

EMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("ema38", T.DoubleType(), False),
    T.StructField("ema100", T.DoubleType(), False),
    T.StructField("trade_timestamp", T.TimestampType(), False),
])

ADVISORY = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("trade_timestamp", T.TimestampType(), False),
    T.StructField("message", T.StringType(), False),
])

# Stored forms: the advisory table names the message column ``advice``; both are partitioned by day.
EMA_TABLE_KEY = ["symbol", "trade_timestamp"]
ADVISORY_TABLE_KEY = ["symbol", "trade_timestamp"]
PARTITION_COLUMN = "trade_date"

PROTO_TIMESTAMP = T.StructType([
    T.StructField("seconds", T.LongType()),
    T.StructField("nanos", T.IntegerType()),
])

QUARANTINE_REASONS = ["bad_id", "bad_timestamp", "bad_price"]
