"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Options for the session of a merge job; none is needed for right results. Increments
# with instants for dates are refused, so the time zone changes none either.
MERGE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="ledgerfold-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/ledgerfold-{uuid4().hex}/{name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
