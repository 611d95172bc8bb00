"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# How many rows may be broadcast, or looked at by the driver, once a count has shown they fit.
# Each such row holds a few numbers and at most one token.
BROADCAST_ROWS = 200_000


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, on the folder the cluster names if it names one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="trawl-checkpoint-")
    context.setCheckpointDir(folder)


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that the driver and all executors share."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
