"""Folders of the cluster's file system, seen from the driver: list, delete.

Metadata calls only, through the Hadoop file system that Spark itself uses, so
any store that Spark writes to is reached.  No file content is read here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in ``folder``, sorted; none if it does not exist."""
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def delete_directories(spark: SparkSession, paths: Sequence[str]) -> int:
    """Delete whole directories (or files); missing ones are skipped.  Returns how many were deleted."""
    deleted = 0
    for p in paths:
        fs, path = _file_system(spark, p)
        deleted += bool(fs.delete(path, True))
    return deleted


def listed_files(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(name, length, modification time in ms) of the data files of ``folder``, sorted; hidden ones are left out."""
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        return []
    found = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path) if s.isFile()]
    return sorted(f for f in found if not f[0].startswith(("_", ".")))


def parent(spark: SparkSession, file: str) -> str:
    """The folder of a file, written as Spark's ``_metadata`` and file listings write it (not URL-encoded)."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent().toString()
