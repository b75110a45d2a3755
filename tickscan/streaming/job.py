"""The streaming analytics job.

``trend_stream``: ticks (stream) -> checks -> watermark on trade time -> tumbling-window bars
(append mode, late rows dropped) -> per-symbol keyed state (EMAs + crossover) -> one row per
closed bar. ``start_job`` fans each micro-batch out to the EMA table and the advisory table
(insert-if-absent, so a replayed batch after a failure changes nothing) inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.ticks import instant, region_of
from ..operators.bars import bars as make_bars
from ..operators.bars import duration_us
from ..operators.clean import quarantine, valid_ticks
from ..operators.history import latest
from ..schemas import DEFAULT_SPANS, DEFAULT_WINDOW, LATENESS_BOUND
from ..session import folder_exists
from ..sinks.tables import latest_times, read_table, write_advisories, write_ema_rows
from .state import EmaCrossoverProcessor, output_schema

STREAM_TICK_SCHEMA = ("id string, sec_type string, last string, trade_timestamp timestamp, "
                      "wallclock_timestamp timestamp, delay bigint, seq bigint")


def read_tick_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None, schema: str = STREAM_TICK_SCHEMA) -> DataFrame:
    """A tick folder as a stream (the file stand-in for a tick topic)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stream_bars(ticks: DataFrame, window: str = DEFAULT_WINDOW, bound: str = LATENESS_BOUND) -> DataFrame:
    """Valid ticks -> watermark (``bound`` out of order) -> closed tumbling-window bars."""
    v = valid_ticks(ticks).withColumn("trade_timestamp", instant("trade_timestamp"))
    return make_bars(v.withWatermark("trade_timestamp", bound), window)


def trend_stream(ticks: DataFrame, window: str = DEFAULT_WINDOW, spans=DEFAULT_SPANS,
                 bound: str = LATENESS_BOUND, ttl_ms: int | None = None, seed: float | str = 0.0,
                 min_bars: int = 0, initial: DataFrame | None = None) -> DataFrame:
    """One row per closed bar with ``ema<span>`` columns and the crossover ``message`` (or NULL).

    A symbol's state is dropped ``ttl_ms`` after its last bar if given (processing time). ``initial``
    (:func:`history_state`) is where symbols start from in a new checkpoint; ticks of the bars it covers
    are left out by :func:`after_history`."""
    b = stream_bars(ticks, window, bound)
    return (b.groupBy("symbol")
             .transformWithState(EmaCrossoverProcessor(spans, seed=seed, ttl_ms=ttl_ms, min_bars=min_bars),
                                 output_schema(spans), "Append", "ProcessingTime" if ttl_ms else "None",
                                 initialState=None if initial is None else initial.groupBy("symbol")))


def history_state(ema_table: DataFrame, spans=DEFAULT_SPANS, times: DataFrame | None = None) -> DataFrame:
    """(symbol, e<span>..., n): the state after each symbol's stored rows, one bar each. Its last row
    holds the EMAs (rounding of stored values goes on with them); ``times`` finds it without a scan."""
    last = latest(ema_table, times=times).select("symbol", *[F.col(f"ema{s}").alias(f"e{s}") for s in spans])
    return last.join(ema_table.groupBy("symbol").agg(F.count("*").alias("n")), "symbol")


def after_history(ticks: DataFrame, times: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """``ticks`` (a stream) without those of windows that the history (symbol, latest) covers already:
    each up to the end of the one that holds the symbol's latest stored time."""
    size = duration_us(window)
    at = F.unix_micros(instant("trade_timestamp"))
    upto = times.select(F.col("symbol").alias("_symbol"), F.unix_micros(instant("latest")).alias("_us"))
    upto = upto.select("_symbol", (F.col("_us") - F.pmod("_us", F.lit(size)) + size).alias("_end"))
    return (ticks.join(upto, F.col("id") == F.col("_symbol"), "left").where(F.col("_end").isNull() | (at >= F.col("_end")))
            .drop("_symbol", "_end"))


def topic_frames(batch: DataFrame, spans=DEFAULT_SPANS, descriptor_file: str | None = None, binary: bool = False) -> DataFrame:
    """EMA rows and advisories of one micro-batch as topic records: ``topic`` (``<region>-ema`` or
    ``<region>-advisories``), ``key`` (symbol bytes), ``value`` (protobuf bytes when a descriptor is
    given or ``binary`` is set, JSON otherwise)."""
    from ..functions.ticks import region_of, topic_name
    from ..sources.kafka import MESSAGE_BY_KIND, to_topic_frame
    ema = batch.select("symbol", *[f"ema{s}" for s in spans], "trade_timestamp")
    adv = batch.where(F.col("message").isNotNull()).select("symbol", "trade_timestamp", "message")

    def routed(rows: DataFrame, kind: str) -> DataFrame:
        frame = to_topic_frame(rows, descriptor_file=descriptor_file, message=MESSAGE_BY_KIND[kind], binary=binary)
        return frame.withColumn("topic", topic_name(region_of(F.col("key").cast("string")), kind))

    return routed(ema, "ema").unionByName(routed(adv, "advisories"))


def write_batch(batch: DataFrame, ema_path: str, advisory_path: str, spans=DEFAULT_SPANS,
                brokers: str | None = None, descriptor_file: str | None = None, token: str | None = None) -> None:
    """Fan one micro-batch out to the EMA and advisory tables (both insert-if-absent, by ``token`` if
    given) and, when ``brokers`` is given, to the per-region EMA and advisory topics."""
    batch = batch.persist()
    try:
        write_ema_rows(batch.select("symbol", *[f"ema{s}" for s in spans], "trade_timestamp"), ema_path,
                       token=token)
        write_advisories(batch.where(F.col("message").isNotNull())
                              .select("symbol", "trade_timestamp", "message"), advisory_path, token=token)
        if brokers:
            # the topics carry the three messages in binary form, for the default spans' fields
            binary = descriptor_file is None and tuple(spans) == DEFAULT_SPANS
            (topic_frames(batch, spans, descriptor_file, binary).write.format("kafka")
                .option("kafka.bootstrap.servers", brokers).option("kafka.compression.type", "snappy").save())
    finally:
        batch.unpersist()


def batch_writer(ema_path: str, advisory_path: str, spans=DEFAULT_SPANS, brokers: str | None = None,
                 descriptor_file: str | None = None):
    """``foreachBatch`` function. Every batch is checked against the stored rows (through the tables'
    ledgers), since a table may have been filled by an earlier stream, a backfill or a batch that died
    half way. A batch's token is the stream's id, which its checkpoint keeps, and the batch number."""
    def write(df: DataFrame, batch_id: int) -> None:
        stream = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        token = f"{stream}-{batch_id}" if stream else None
        write_batch(df, ema_path, advisory_path, spans, brokers, descriptor_file, token)
    return write


def start_job(ticks: DataFrame, ema_path: str, advisory_path: str, checkpoint: str,
              window: str = DEFAULT_WINDOW, spans=DEFAULT_SPANS, bound: str = LATENESS_BOUND,
              processing_time: str = "5 seconds", quarantine_path: str | None = None,
              brokers: str | None = None, descriptor_file: str | None = None, region: str | None = None,
              ttl_ms: int | None = None, seed: float | str = 0.0, min_bars: int = 0, from_history: bool = False,
              dead_letters: DataFrame | None = None, dead_letter_path: str | None = None) -> list[StreamingQuery]:
    """Start the job: EMA/advisory tables via ``foreachBatch``; optionally the quarantine and the
    undecodable topic records (``dead_letters``) as sinks of their own, one region only, and topics out.

    ``from_history``: a job whose checkpoint is gone goes on from the EMA table instead of zero. What
    the history covers is fixed when the job first starts and kept beside the checkpoint for restarts."""
    spark = ticks.sparkSession
    if region:
        ticks = ticks.where(region_of("id") == region)
    initial = None
    if from_history:
        initial, times = _bootstrap(spark, ema_path, checkpoint, spans)
        ticks = after_history(ticks, times, window)
    out = trend_stream(ticks, window, spans, bound, ttl_ms, seed, min_bars, initial)
    q = (out.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint + "/trend")
            .foreachBatch(batch_writer(ema_path, advisory_path, spans, brokers, descriptor_file))
            .trigger(processingTime=processing_time)
            .start())
    queries = [q]
    extra = [("quarantine", quarantine(ticks), quarantine_path)] if quarantine_path else []
    if dead_letters is not None and dead_letter_path:
        extra.append(("dead-letters", dead_letters, dead_letter_path))
    for name, rows, path in extra:
        queries.append(rows.writeStream.format("parquet").option("checkpointLocation", f"{checkpoint}/{name}")
                       .option("path", path).trigger(processingTime=processing_time).start())
    return queries


def _bootstrap(spark: SparkSession, ema_path: str, checkpoint: str, spans) -> tuple[DataFrame, DataFrame]:
    """(initial state, latest times) of the EMA table as the job first found it, written beside the
    checkpoint: one row for each symbol."""
    at = f"{checkpoint}/history"
    if not folder_exists(f"{at}/state/_SUCCESS"):
        table, times = read_table(spark, ema_path), latest_times(spark, ema_path)
        times.write.mode("overwrite").parquet(f"{at}/times")
        history_state(table, spans, times).write.mode("overwrite").parquet(f"{at}/state")
    return spark.read.parquet(f"{at}/state"), spark.read.parquet(f"{at}/times")


def capture_topics(spark: SparkSession, brokers: str, topics, out_path: str, checkpoint: str,
                   starting: str = "earliest", descriptor_file: str | None = None, decoded: bool = False) -> list[StreamingQuery]:
    """Capture topic records to CSV, one folder per kind and topic, stamped with the capture time.

    Reads every record available now from ``starting`` and stops (a bounded run, like a capture of a
    fixed duration over a replayed day). With a descriptor file or ``decoded`` the values are decoded with
    the message of their kind into flat columns, one query for each kind; otherwise key, value (text), topic, partition, offset and broker timestamp are kept.
    """
    from ..sinks.files import capture_batch
    from ..sources.kafka import decode_kinds, flat_message, kafka_reader
    rec = kafka_reader(spark, brokers, topics, starting)
    if descriptor_file or decoded:
        frames = {k: flat_message(d, "topic") for k, d in decode_kinds(rec, descriptor_file).items()}
    else:
        frames = {"records": rec.select("topic", "kind", "partition", "offset", "timestamp",
                                        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))}
    return [(f.writeStream.foreachBatch(capture_batch(f"{out_path}/{name}"))
              .option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start())
            for name, f in frames.items()]
