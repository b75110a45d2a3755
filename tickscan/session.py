"""Spark session settings and the shared folder for lineage cuts and stream checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on. UTC matters for window alignment and for the
# timestamp <-> epoch conversions; the state store provider is needed by the EMA stateful processor.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings a query needs on a session it did not create (runtime SQL settings only).
RUNTIME_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def ship_package(spark: SparkSession) -> None:
    """Make the Python code that runs in workers (the stateful EMA processor) independent of this
    package being installed there: its classes and functions are pickled by value."""
    import sys
    from pyspark import cloudpickle
    pkg = sys.modules[__name__.split(".")[0]]
    try:
        cloudpickle.register_pickle_by_value(pkg)
    except ValueError:
        pass  # already registered


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a session made elsewhere, and ship the
    package to the Python workers."""
    for k, v in RUNTIME_REQUIRED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickscan", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are only set when given, so that on a cluster the
    submit-time configuration wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever submits the job (a path every executor and the
    driver can reach). Only a local-mode session without the setting gets a private folder
    under the system temp dir, as in tests.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="tickscan-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, for written intermediate tables and stream state."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def write_and_read(df, name: str, spark: SparkSession | None = None):
    """Write ``df`` as Parquet to a fresh folder under the shared folder and return a DataFrame over it.

    Cuts the lineage where a result feeds several branches of a plan (so nothing upstream is
    computed twice) and gives later stages a restart point that survives executor loss.
    """
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._written_at = path
    return out


def drop_written(*tables) -> None:
    """Delete tables that ``write_and_read`` wrote and that nothing reads any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(df._written_at)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def folder_exists(path: str) -> bool:
    """Whether ``path`` is there, in any store Spark knows."""
    sc = SparkSession.getActiveSession().sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)
