"""Session helpers: a tuned SparkSession for local runs and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on. Timestamps are TIMESTAMP_NTZ end to end, so the
# session zone only matters for literals; UTC keeps them stable across machines.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small shuffles feeding CPU-heavy stages (window sums, many aggregates) should still use
    # every core locally; at cluster data sizes partitions are far above this floor anyway.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "courtside", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the cluster's own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    n = shuffle_partitions or (8 if cpus == "*" else max(2, int(cpus) * 2))
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(n)
    conf.setdefault("spark.driver.memory", os.environ.get("COURTSIDE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured and the master is local (tests, bench) a fresh scratch
    folder is made and set. On a cluster that is an error: executors would each write to
    their own disk, and later reads would miss those files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(f"spark.checkpoint.dir is not set: master {sc.master} needs a folder that all executors share")
    local = tempfile.mkdtemp(prefix="courtside-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/courtside/{name}-{uuid.uuid4().hex[:12]}"
