"""Session services that must come from the cluster, not from this process."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
STAGED_ROW_GROUP = 8 << 20  # bytes; a scan is shared out by row groups


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; make one up only for a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    context.setCheckpointDir(shared)
    return shared


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame as a table in the checkpoint folder and go on from the table.

    Used where the same rows are read several times (global statistics, iterative fits): the plan
    above runs once, later readers take only their columns, and a lost executor costs a re-read.
    Row groups are small, so that many tasks can read what few tasks wrote.
    The folder's owner decides how long the tables stay.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", STAGED_ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
