"""Where a job keeps data it must not lose with an executor."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where the setting is unset, a local session gets a temporary folder; a cluster has no safe
    default, so there it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="visitrisk-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def application_folder(spark: SparkSession, name: str) -> str:
    """A folder for one named dataset of this Spark application, overwritten when it runs again."""
    root = shared_folder(spark).rstrip("/")
    return f"{root}/visitrisk-{spark.sparkContext.applicationId}/{name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` fixed in the shared folder, so that a recomputation cannot change them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
