"""Folders of any file system that Spark reaches: is there one, what is in it (one level), move it, remove it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _opened(spark, path)
    return system.exists(at)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; no file is listed or opened."""
    at, system = _opened(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(at) if s.isDirectory()) if system.exists(at) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Puts the folder ``source`` in the place of ``target``, whose present content goes."""
    at, system = _opened(spark, target)
    system.mkdirs(at.getParent())
    system.delete(at, True)
    if not system.rename(_opened(spark, source)[0], at):
        raise OSError(f"cannot move {source} to {target}")


def remove_if_empty(spark: SparkSession, path: str) -> None:
    """Remove a folder in which there is no other one."""
    if not subfolders(spark, path):
        remove(spark, path)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    at, system = _opened(spark, path)
    system.create(at, True).close()


def remove(spark: SparkSession, path: str) -> None:
    at, system = _opened(spark, path)
    system.delete(at, True)
