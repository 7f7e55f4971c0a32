"""Partition-count guard for CPU-heavy per-row text work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a frame only when it has fewer partitions than cores.

    A cluster scan of many files already has thousands of splits and is left
    alone; a single small file (one row group, one task) is spread so per-row
    text work is not serialised on one core.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # a Spark Connect session has no RDD view: leave the plan as is
        return df
    return df if have >= want else df.repartition(want)


def spread_by_key(df: DataFrame, key: str, files: int) -> DataFrame:
    """Deal the rows of at most ``files`` files over all cores by key, where that is fewer files than cores.

    Partitions don't tell: a scan cuts a file into splits by bytes, but only those with the
    start of a row group get rows.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # a Spark Connect session has no RDD view: leave the plan as is
        return df
    # a hash of its own: files dealt by the key's plain hash hold few remainders of it
    return df if files >= cores else df.repartition(max(cores, have), F.xxhash64(key))
