"""Session helpers: a local session for tests/bench and the shared checkpoint folder.

On a cluster the session is built by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A folder is set here only when the setting is
missing (local tests), never in place of a cluster's own setting.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "eventloom", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if none is configured."""
    current = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
    # One process: its temp folder is shared by all tasks.
    local = tempfile.mkdtemp(prefix="eventloom-ckpt-")
    spark.conf.set(_CHECKPOINT_KEY, local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark)
    # setCheckpointDir may have appended a per-application sub folder; use the configured root.
    return f"{base}/{name}-{uuid.uuid4().hex}"
