"""M2: the run ledger, one event a partition (year, court_code, bench) and run.

A run appends its events under ``{root}/ledger/run=<id>`` and overwrites nothing; the latest event
of a partition is its state. A partition is ``finished`` only after every sink
of its run was written, ``failed`` when one of its files can't be read, and ``started`` when
the run ended before either, so a resumed run takes up the partitions that
aren't finished.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.sources.files import exists
from lexcurate.sources.metadata import ERROR, FILE

STARTED, FINISHED, FAILED = "started", "finished", "failed"
KEYS = ["year", "court_code", "bench"]
SCHEMA = "year string, court_code string, bench string, state string, records long, file string, error string, run string, at double"


def events(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/ledger"
    return spark.read.schema(SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], SCHEMA)


def append(spark: SparkSession, root: str, run: str, partitions: DataFrame, state: str) -> None:
    """``partitions``: run keys, and where known ``records``, FILE and ERROR."""
    known = {c: (F.col(c) if c in partitions.columns else F.lit(None)) for c in ("records", FILE, ERROR)}
    rows = partitions.select(*KEYS, F.lit(state).alias("state"), known["records"].cast("long").alias("records"),
                             known[FILE].cast("string").alias("file"), known[ERROR].cast("string").alias("error"),
                             F.lit(run).alias("run"), F.lit(time.time()).alias("at"))
    rows.coalesce(1).write.mode("append").parquet(f"{root}/ledger")


def states(spark: SparkSession, root: str) -> DataFrame:
    """The latest event of every partition; of two failed files of one, the first by name."""
    rows = events(spark, root)
    rest = [c for c in rows.columns if c not in KEYS]
    failure = F.col("state") == FAILED
    order = F.struct("at", failure.alias("f"), F.when(failure, F.hash("file")).alias("h"))
    latest = rows.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), order).alias("e"))
    return latest.select(*KEYS, *[F.col(f"e.{c}").alias(c) for c in rest])
