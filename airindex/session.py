"""Session helpers: a UTC session with adaptive execution, and shared scratch paths.

A "day" in this library is the UTC calendar day, so every entry point pins
``spark.sql.session.timeZone`` to UTC. Scratch output (round trips, lineage
cuts) always lives below the cluster's shared ``spark.checkpoint.dir``; we only
pick a directory of our own when the session has none, as in unit tests.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesce shuffle partitions to the advisory size rather than keeping as many
    # tasks as cores: fewer, fuller tasks (Spark's recommendation outside tests).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    # PySpark 4 records the Python call site of every Column operation for error
    # messages; that costs about ten driver round trips per operation when plans
    # are built. Batch jobs keep Spark's own error context without it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "airindex",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured for this library."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Days are UTC days: pin the session zone (a runtime SQL setting)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; set one only when unset.

    On a cluster a ``file:`` folder is accepted only if the session's own configuration names
    it (a mount that every machine shares); a folder is never made up there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _one_machine(sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder (HDFS, object store) "
                "that every executor can reach; checkpoints and scratch tables go there")
        # Local runs and unit tests only: one machine, so a local folder is shared.
        configured = tempfile.mkdtemp(prefix="airindex-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _one_machine(master: str) -> bool:
    """``local``, ``local[4]``, ``local[4,2]``: executor threads of the driver itself."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written intermediates."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/airindex-scratch/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more (no error if it is absent)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
