"""Session helpers: a local session for tests/bench and the shared scratch root.

On a cluster the scratch root is the shared folder named by ``spark.checkpoint.dir``
(or the context's checkpoint directory). Only when neither is set — a local test
session — do we create one under the machine's temp folder and register it.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewater",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared scratch root: the session's checkpoint directory.

    Reads ``spark.checkpoint.dir`` first, then the context's checkpoint dir; sets a
    fresh local one only when both are unset (local runs and tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared scratch root."""
    name = "/".join(p.strip("/") for p in parts if p)
    return f"{work_dir(spark)}/tidewater/{name}/{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A catalog-safe unique identifier (letters, digits, underscore)."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
