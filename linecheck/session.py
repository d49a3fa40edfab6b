"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold for any data size; sizes of clusters and partitions stay
# with whoever submits the job.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: str | int = "*", app: str = "linecheck", **extra: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = tempfile.mkdtemp(prefix="linecheck-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/linecheck/{name}-{uuid.uuid4().hex}"
