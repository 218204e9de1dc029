"""Which dated datasets are past their time. Listing only: deleting is the caller's decision."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitrisk.sources.folders import subfolders


@dataclass(frozen=True)
class Retention:
    """Days until a dataset expires and, where it has one, until it moves to colder storage."""

    dataset: str
    expire_after: int
    archive_after: int | None = None


# How long each kind of data is kept.
RETENTION = (
    Retention("training", 90),
    Retention("inference", 30),
    Retention("models", 365, archive_after=90),
)


def partition_days(spark: SparkSession, dataset: str, path: str, partition: str) -> DataFrame:
    """``(dataset, day)`` of a dataset's date partitions, from the folders one level below ``path``.

    A partition folder whose name is no date is listed with a NULL day.
    """
    prefix = f"{partition}="
    names = [n.removeprefix(prefix) for n in subfolders(spark, path) if n.startswith(prefix)]
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    return listed.select(F.lit(dataset).alias("dataset"), F.col("name").try_cast("date").alias("day"))


def model_days(versions: DataFrame, dataset: str = "models") -> DataFrame:
    """``(dataset, day, model_version)`` of the registered models, by the day each was last trained."""
    last = versions.groupBy("model_version").agg(F.to_date(F.max("trained_at")).alias("day"))
    return last.select(F.lit(dataset).alias("dataset"), "day", "model_version")


def _before(days: int, as_of: date) -> Column:
    return F.col("day") < F.lit((as_of - timedelta(days=days)).isoformat()).cast("date")


def due_partitions(days: DataFrame, as_of: date, rules: tuple[Retention, ...] = RETENTION) -> DataFrame:
    """The rows of ``days`` (dataset, day, any more) to expire or to archive as of a day, with ``action``."""
    action = F.lit(None).cast("string")
    for rule in rules:
        here = F.col("dataset") == rule.dataset
        if rule.archive_after is not None:
            action = F.when(here & _before(rule.archive_after, as_of), "archive").otherwise(action)
        action = F.when(here & _before(rule.expire_after, as_of), "expire").otherwise(action)
    return days.withColumn("action", action).filter(F.col("action").isNotNull())
