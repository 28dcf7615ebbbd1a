"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally: AQE re-plans shuffles at
# runtime (coalesces tiny partitions, splits skewed ones), UTC keeps timestamp
# text stable.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "statforge",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given, so a cluster submit keeps its own master.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a folder every
    executor can reach), and a session without one is refused. Only a session on one
    machine (a local master) may do without; it uses a folder in its warehouse.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = f"{warehouse.rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/statforge-{name}-{uuid.uuid4().hex[:12]}"
