"""Session helpers: a local session for tests and benchmarks, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "silverlode", cpus: str | int = "*", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster no executor
    could see the driver's own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not configured and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="silverlode-"))
    return configured or context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path (not yet created) inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
