"""Session and cluster helpers.

* ``get_spark`` builds a session for tests, the bench and local runs.  On a
  cluster, pass your own session to the library functions instead.
* ``shared_dir`` returns a fresh folder under the cluster's shared
  ``spark.checkpoint.dir``; only a local session gets a default when it is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "urbanlake") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("URBANLAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint dir.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is.  Only a local session may do without: it gets a temporary folder.
    Elsewhere the executors would write to disks of their own, so a missing
    setting is an error.  Sessions without a SparkContext (Spark Connect) use
    the configuration value.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if sc is None or not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="urbanlake-ckpt-")
    if sc is None:
        return conf
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """Driver and executors in one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint dir."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
