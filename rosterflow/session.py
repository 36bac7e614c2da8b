"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces small
# shuffle partitions at runtime; skew-join splits hot partitions so one
# branch or patron holding a third of the rows does not pin one task.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # Keep CPU-heavy text stages parallel when a shuffle's output is small
    # (daily drops, tests); partitions of large inputs are far above this.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "rosterflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
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
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder has to be configured (a shared file system path):
    a folder of one machine would hold only that executor's files.  In local
    mode, as in tests, one is created when the setting is absent.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="rosterflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:  # classic sessions: DataFrame.checkpoint() writes here too
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
    except Exception:  # remote (Connect) sessions have no SparkContext
        pass
    return current


def state_path(spark: SparkSession, name: str) -> str:
    """Location for a cross-run state table inside the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "state", name)

