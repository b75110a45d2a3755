"""The job's keyed state as a table, read from a checkpoint with Spark's state data source.

Works while the job runs (the state of its last finished batch is read) and after it has stopped, on
any store Spark knows; every state partition is read by a task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DEFAULT_SPANS
from .state import STATE_NAME


def ema_operator(spark: SparkSession, checkpoint: str) -> int:
    """The number of the keyed-state operator in the job's plan."""
    found = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorName").startswith("transformWithState"))
    rows = found.select("operatorId").distinct().collect()  # one row
    if len(rows) != 1:
        raise ValueError(f"no single keyed state in {checkpoint}")
    return rows[0]["operatorId"]


def ema_state(spark: SparkSession, checkpoint: str, spans=DEFAULT_SPANS, batch: int | None = None) -> DataFrame:
    """(symbol, ema<span>..., bars) of every symbol after the last batch, or after ``batch``. ``checkpoint``
    is the folder of the query (``<job checkpoint>/trend``)."""
    r = (spark.read.format("statestore").option("operatorId", ema_operator(spark, checkpoint)).option("stateVarName", STATE_NAME))
    if batch is not None:
        r = r.option("batchId", batch)
    state = r.load(checkpoint)
    value = F.col("value")
    # a value with a time to live is wrapped
    held = value["value"] if "value" in state.schema["value"].dataType.names else value
    names = [f"e{s}" for s in spans]
    return state.select(F.col("key")[state.schema["key"].dataType.names[0]].alias("symbol"),
                        *[held[n].alias(f"ema{s}") for n, s in zip(names, spans)], held["n"].alias("bars"))
