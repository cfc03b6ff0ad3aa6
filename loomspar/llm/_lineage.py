"""Cutting a plan's lineage through files that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The folder that spark.checkpoint.dir names; where it is unset, a temporary one for a local master only."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: executors of a cluster need a folder that all of them share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint"))


def cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stage_folder(spark: SparkSession) -> str:
    """A new folder for tables that one run writes and reads again, beside the checkpoints."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stages-{uuid.uuid4().hex}"
