"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "monthline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Every setting can be overridden by keyword (dots written as ``__``), and an
    already running session is returned as it is.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="monthline-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the copy."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared checkpoint folder for a written intermediate table."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
