"""Places for tables that live as long as a job, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir (or the folder of setCheckpointDir); a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="barmart-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
