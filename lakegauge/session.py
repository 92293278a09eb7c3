"""A session with the settings that this library expects."""

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, besides what the cluster's own path holds."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else a temporary one of this session on a local master."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lakegauge-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder there."""
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared folder, with the partitions it has; later passes see the same ones."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared(df.sparkSession))
    return df.checkpoint()


def build(app: str = "lakegauge", master: str | None = None, **conf: str) -> SparkSession:
    """UTC times, adaptive execution with skew handling; a cluster's own settings stay unless given here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    return builder.config(map=settings | conf).getOrCreate()
