"""Session settings and the shared staging area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs a later aggregate one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every transform relies on to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "gridweave", master: str | None = None, **settings: str) -> SparkSession:
    """Create a configured session; `settings` use `_` for `.` in their names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return configure(builder.getOrCreate())


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the cluster's shared checkpoint folder.

    A private temporary folder is used only in local mode with no folder configured; on a cluster it
    would be invisible to other machines, so that case is an error.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        _local_root = _local_root or tempfile.mkdtemp(prefix="gridweave-")
        root = _local_root
    return f"{root.rstrip('/')}/gridweave/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table in the staging area and read it back.

    Cuts the lineage, survives lost executors, and pins rows whose placement must not change between
    the several passes that read them.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
