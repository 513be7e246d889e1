"""Session helpers: settings the library relies on and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "ruleweave", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass your own builder settings instead."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local["):
        conf["spark.ruleweave.read.minPartitions"] = str(os.cpu_count() if "*" in master else master[6:-1].split(",")[0])
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session (tests) may have none: it gets a fresh scratch folder. On a cluster
    every executor would write to its own disk, so that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        current = current or sc.getCheckpointDir()
    except Exception:  # remote session: no SparkContext
        pass
    if not current:
        if sc is not None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ruleweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder, for staged tables and stream checkpoints."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])
