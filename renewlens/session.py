"""SparkSession helpers.

Library code never builds its own session: every operator takes the caller's
DataFrames. ``local_session`` exists for tests, the bench and the driver entry.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cores: str | int = "*", app: str = "renewlens") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only in local mode, where driver and executors are one
    process, an unset folder is replaced by a fresh scratch folder; on any
    other master it is an error, as a folder of the driver is not shared.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="renewlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
