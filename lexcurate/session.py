"""Session settings every job relies on.

Cluster jobs get their session from the platform; ``configure`` only sets
what the operators need for correct answers (UTC, string partition values,
dynamic partition overwrite, AQE) and never overrides a checkpoint
directory the cluster already names.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on for correct and scalable plans.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # partition values such as 16~20, 36_29 or None must stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # texts may be long; a batch of them must fit a Python worker
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lexcurate") -> SparkSession:
    """A local session for tests and the bench; the UI stays off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEXCURATE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local data is a few MB per shuffle: coalescing by bytes would merge it
        # into one or two tasks and leave CPU-bound text work on a core or two
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a scratch folder only when unset in a local session (tests)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    conf = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not conf and not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not conf:
        conf = tempfile.mkdtemp(prefix="lexcurate-ckpt-", dir="/tmp")
        try:
            spark.conf.set("spark.checkpoint.dir", conf)
        except Exception:  # a core setting some sessions refuse at runtime; the context still gets it
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written stage tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def size_for_input(spark: SparkSession, input_bytes: int, split_bytes: int = 512 << 20,
                   min_partitions: int = 200, max_partitions: int = 20_000) -> dict:
    """Partition sizing for a run over ``input_bytes`` of document text.

    Scans take splits of 512 MB (at 100 TB some 200,000 map tasks); the texts of
    a split stream through a task, so its memory doesn't grow with it. A shuffle
    has one block for each pair of map and reduce tasks, so reducers stop at
    20,000 and take more each from there on; AQE splits the skewed ones and
    joins small ones. Shuffle partitions are always sized; the other values
    are set only where the session leaves them unset.
    """
    parts = min(max_partitions, max(min_partitions, -(-input_bytes // split_bytes)))
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 << 20),
    }
    applied = {}
    for k, v in wanted.items():
        if spark.conf.get(k, None) in (None, "") or k == "spark.sql.shuffle.partitions":
            spark.conf.set(k, v)
            applied[k] = v
    return applied
