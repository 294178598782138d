"""Session helpers.

Library code never hard-codes a machine-local folder: shared scratch space is
derived from ``spark.checkpoint.dir`` (which a cluster points at shared storage).
Only when that setting is absent (local tests) do we set one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "corpusmill") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSMILL_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.  Unset, a local master (tests) gets a temporary one; on
    a cluster that is an error, as executors would write to their own disks."""
    current = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="corpusmill-ckpt-")
    spark.conf.set(_CHECKPOINT_KEY, local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for files a job writes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/corpusmill-{name}-{uuid.uuid4().hex[:12]}"
