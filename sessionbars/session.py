"""Session construction and the shared scratch location.

Intermediate tables and streaming checkpoints go under the folder the
cluster names in ``spark.checkpoint.dir``.  A private temporary folder is
only created when that setting is absent *and* the master is local (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Let a join whose big side is already hash-partitioned on a subset of the
    # join keys (bars on (symbol, date) joined to their block table on
    # (symbol, date, slice, sub)) keep that partitioning and shuffle only the
    # small side.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Streaming state (window aggregates, position keeper) lives in RocksDB,
    # off the JVM heap, so large state does not pressure executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app: str = "sessionbars",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Timestamps are wall-clock (NTZ) in the data; keep any cast stable.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        # getCheckpointDir appends a per-application uuid folder; use its parent
        # so that streaming checkpoints survive a driver restart.
        return root.rsplit("/", 1)[0]
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        sc.setCheckpointDir(root)
        return root
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="sessionbars-ckpt-")
    sc.setCheckpointDir(root)
    return root


def _folder(spark: SparkSession, name: str) -> str:
    path = f"{checkpoint_root(spark).rstrip('/')}/sessionbars/{name}"
    # through the file system that the path names, which need not be the driver's own
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return _folder(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def stream_path(spark: SparkSession, name: str) -> str:
    """A live stream's own folder under the shared checkpoint root: the same in
    every run, so that a restarted driver goes on from the stream's checkpoint."""
    return _folder(spark, f"streams/{name}")
