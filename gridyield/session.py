"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: The default timestamp type of Parquet files, INT96, has no statistics: no row group could be skipped by time.
STATISTICS = ("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def build_session(app: str = "gridyield", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config(*STATISTICS)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are UTC, since calendar features must not depend on the machine's zone, and are written with statistics."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(*STATISTICS)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the cluster; a temporary one only for a local master without a setting."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if configured:
        context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    context.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
