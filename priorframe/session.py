"""Spark session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "priorframe", cores: str = "*") -> SparkSession:
    """Session for tests and benchmarks; a cluster supplies its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call site per expression
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    The cluster names the shared root in ``spark.checkpoint.dir``. A machine-local
    folder is used only by a local master, where every task sees it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="priorframe-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
