"""File-system steps around Spark jobs, on whatever file system the path is on."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _at(spark, path)
    return fs.exists(hadoop_path)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _at(spark, path)
    fs.mkdirs(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _at(spark, path)
    fs.delete(hadoop_path, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or directory; nothing may be at ``to``, whose parent has to be there."""
    fs, hadoop_path = _at(spark, path)
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise ValueError(f"there is a {to}")
    if not fs.rename(hadoop_path, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be renamed to {to}")


def children(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of what is right below ``path``, and the seconds since each was last changed."""
    fs, hadoop_path = _at(spark, path)
    if not fs.exists(hadoop_path):
        return {}
    now = time.time()
    found = fs.listStatus(hadoop_path)
    return {entry.getPath().getName(): now - entry.getModificationTime() / 1000 for entry in found}


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the session's process ends."""
    fs, hadoop_path = _at(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """With the file system that it is on."""
    fs, hadoop_path = _at(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right below ``path``; none when it does not exist."""
    fs, hadoop_path = _at(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [entry.getPath().getName() for entry in fs.listStatus(hadoop_path) if entry.isDirectory()]


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted paths that match a glob pattern."""
    fs, hadoop_path = _at(spark, pattern)
    return sorted(entry.getPath().toString() for entry in fs.globStatus(hadoop_path) or [])


def must_be_shared(spark: SparkSession, path: str) -> None:
    """An error if the path is a folder of each machine's own and the session has several machines."""
    if qualified(spark, path).startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{path} is another folder on each machine: set spark.checkpoint.dir to one that all share")
