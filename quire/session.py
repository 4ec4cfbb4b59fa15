"""Session helpers.

Library code never overrides settings a cluster already carries; these
helpers only fill in what is unset (local runs, tests, bench).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Defaults for local runs; on a cluster the submitter's values win.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

MAX_BROADCAST_BYTES_CONF = "quire.broadcast.maxBytes"
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "quire") -> SparkSession:
    """A local-mode session for tests and benchmarks (UI off, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name one (a shared, fault-tolerant location); without it
    this raises. Only a single-process local session that names none gets a
    scratch folder of its own, removed when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def max_broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_BROADCAST_BYTES_CONF, str(DEFAULT_MAX_BROADCAST_BYTES)))
