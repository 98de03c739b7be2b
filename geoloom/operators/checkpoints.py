"""Cutting lineage between rounds of an iterative operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point reliable checkpoints at the cluster's shared folder.

    ``spark.checkpoint.dir`` wins. A temporary folder is used only when nothing
    is set and the session is a local one, where driver and tasks share a disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Later reads survive lost executors, prune columns, and carry true sizes, so the
    optimiser's choice of join does not rest on estimates compounded over rounds.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
