"""Listing and deleting through the file system that Spark reads from, whatever it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _open(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _open(spark, path)
    fs.delete(p, True)


def glob(spark: SparkSession, pattern: str, files_only: bool = False) -> list[str]:
    """Sorted paths that match; none if there is no such folder."""
    p, fs = _open(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [] if s.isFile() or not files_only)


def rename(spark: SparkSession, path: str, name: str) -> None:
    """Gives a file another name in its folder."""
    p, fs = _open(spark, path)
    fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), name))
