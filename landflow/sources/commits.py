"""Folders that are there or not: what a job that died has left behind is never seen.

Spark puts ``_SUCCESS`` into a folder when all of a job's output is in place.  A commit is such a folder
with a name of its own, so a new attempt never meets an old one's remains.  Names are listed by the
file system that Spark itself uses, which works for any store that Spark can read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DONE = "_SUCCESS"


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder, jvm


def unique(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` that are complete, in order."""
    store, folder, jvm = _store(spark, path)
    found = store.globStatus(jvm.org.apache.hadoop.fs.Path(folder, f"*/{DONE}")) or []
    return sorted(status.getPath().getParent().getName() for status in found)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of all folders below ``path``, complete or not."""
    store, folder, _ = _store(spark, path)
    if not store.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(folder) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    store, folder, _ = _store(spark, path)
    store.delete(folder, True)

