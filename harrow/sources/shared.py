"""The folder that driver and executors share, for tables and checkpoints between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """What spark.checkpoint.dir or the context names. Only a local master gets a temporary folder where neither is set: elsewhere executors
    couldn't see it, so that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="harrow-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_folder(spark: SparkSession) -> str:
    """A new folder in it."""
    return f"{checkpoint_root(spark).rstrip('/')}/harrow-{uuid.uuid4().hex}"
