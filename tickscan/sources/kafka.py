"""Topic sources and sinks (Kafka) and the binary message decode.

The tick, EMA and advisory topics carry one protobuf message per record, keyed by the symbol.
``kafka_reader`` builds the ``readStream`` for one or many topics; ``decode`` turns the binary
value into columns, with ``from_protobuf`` (needs the ``spark-protobuf`` package and a descriptor
file) or by the package's own codec of the three messages, keeping undecodable records as a dead-letter column instead of failing the query.
``to_topic_frame`` shapes rows into the ``key``/``value`` layout the Kafka sink writes.

Spark's Kafka sink is at-least-once; consumers de-duplicate on ``(symbol, trade_timestamp)``,
which the history tables already do. The Kafka connector jar is not part of a plain PySpark
install; these builders only need it when the query starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ticks import from_proto_ts, topic_kind
from ..functions.wire import from_wire, to_wire

# Message names in the shared message definition, per topic kind.
MESSAGE_BY_KIND = {"ticks": "FinancialTick", "ema": "EMAResult", "advisories": "BuyAdvisory"}


def kafka_options(brokers: str, topics, starting: str = "latest", group: str | None = None,
                  extra: dict | None = None) -> dict[str, str]:
    """Source options: one or many topics (comma list), start offsets, optional consumer group.

    Lost offsets fail the query (Spark's default); a caller who accepts the loss says so in ``extra``.
    """
    topics = [topics] if isinstance(topics, str) else list(topics)
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(topics), "startingOffsets": starting}
    if group:
        opts["kafka.group.id"] = group
    opts.update(extra or {})
    return opts


def kafka_reader(spark: SparkSession, brokers: str, topics, starting: str = "latest",
                 group: str | None = None, stream: bool = True, extra: dict | None = None) -> DataFrame:
    """Records of the topics with ``topic, partition, offset, timestamp, key, value`` and ``kind``."""
    if not stream and starting == "latest":
        raise ValueError("a batch read of topics needs a start before the latest offset")
    opts = kafka_options(brokers, topics, starting, group, extra)
    r = spark.readStream if stream else spark.read
    df = r.format("kafka").options(**opts).load()
    return df.withColumn("kind", topic_kind("topic"))


def decode(records: DataFrame, descriptor_file: str | None = None, message: str | None = None) -> DataFrame:
    """Decode ``value`` to ``msg`` (NULL for bad records): with ``from_protobuf`` and a descriptor file,
    or without one by the package's own reading of the three messages (``functions/wire.py``)."""
    name = message or MESSAGE_BY_KIND["ticks"]
    if descriptor_file is None:
        return records.withColumn("msg", from_wire(F.col("value"), name))
    from pyspark.sql.protobuf.functions import from_protobuf
    return records.withColumn("msg", from_protobuf("value", name, descFilePath=descriptor_file,
                                                   options={"mode": "PERMISSIVE"}))


def decode_kinds(records: DataFrame, descriptor_file: str | None = None) -> dict[str, DataFrame]:
    """Per kind, its records decoded with the kind's own message."""
    return {kind: decode(records.where(F.col("kind") == kind), descriptor_file, message)
            for kind, message in MESSAGE_BY_KIND.items()}


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that decoded, dead letters: the raw records whose value did not decode)."""
    return decoded.where(F.col("msg").isNotNull()), decoded.where(F.col("msg").isNull()).drop("msg")


def _flat(decoded: DataFrame, field: str):
    """A field of ``msg``; a ``{seconds, nanos}`` struct becomes a timestamp."""
    kind = decoded.schema["msg"].dataType[field].dataType
    c = F.col("msg")[field]
    return (from_proto_ts(c) if isinstance(kind, T.StructType) else c).alias(field)


def flat_message(decoded: DataFrame, *kept: str) -> DataFrame:
    """The columns ``kept`` and every field of ``msg``, without nesting (as the CSV capture needs)."""
    return decoded.select(*kept, *[_flat(decoded, f.name) for f in decoded.schema["msg"].dataType.fields])


def topic_ticks(decoded: DataFrame) -> DataFrame:
    """Decoded tick records as ticks; the record's offset orders ticks of equal trade time."""
    names = ("id", "sec_type", "last", "trade_timestamp", "wallclock_timestamp", "delay")
    return decoded.select(*[_flat(decoded, n) for n in names], F.col("offset").alias("seq"))


def to_topic_frame(rows: DataFrame, key: str = "symbol", descriptor_file: str | None = None,
                   message: str | None = None, binary: bool = False) -> DataFrame:
    """``key`` = symbol bytes; ``value`` = protobuf bytes when a descriptor is given or ``binary`` is set
    (then by ``functions/wire.py``), JSON otherwise."""
    payload = F.struct(*[F.col(c) for c in rows.columns])
    if descriptor_file:
        from pyspark.sql.protobuf.functions import to_protobuf
        value = to_protobuf(payload, message or MESSAGE_BY_KIND["ema"], descFilePath=descriptor_file)
    elif binary:
        value = to_wire(payload, message or MESSAGE_BY_KIND["ema"])
    else:
        value = F.to_json(payload).cast("binary")
    return rows.select(F.col(key).cast("binary").alias("key"), value.alias("value"))


def kafka_sink_options(brokers: str, topic: str, checkpoint: str) -> dict[str, str]:
    """Sink options: one topic, snappy compression, checkpointed."""
    return {"kafka.bootstrap.servers": brokers, "topic": topic, "checkpointLocation": checkpoint,
            "kafka.compression.type": "snappy"}
