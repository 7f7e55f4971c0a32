"""K1-K7: sinks, all partitioned writes with dynamic partition overwrite.

Rerunning a job rewrites exactly the partitions it produced, so a retried or
repeated run is idempotent and two benches of one court-year never overwrite
each other (every sink is partitioned down to the bench).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.functions import keys as K
from lexcurate.sinks import keyed
from lexcurate.operators.upsert import upsert_date, upsert_table


#: Bytes under which AQE puts folders into one task. A file costs more than its bytes, so many small folders are dealt over all cores.
LEAST_TASK_BYTES = "1k"


@contextmanager
def folders_dealt_out(spark):
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    spark.conf.set(key, LEAST_TASK_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet", **options: str) -> str:
    """Dynamic partition overwrite. Rows of a partition are brought together first (a large one is split again), as
    otherwise each task would write a small file for every partition."""
    with folders_dealt_out(df.sparkSession):
        (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .options(**options).partitionBy(*partition_by).format(fmt).save(path))
    return path


RUN_PATH = ["court_path", "court_code", "year", "bench"]


def log_json(log: DataFrame) -> DataFrame:
    """K2 record shape: ``lang_*`` as the two-element ``[lang, prob]`` arrays of the JSON log."""
    def arr(c):
        return F.when(F.col(c).isNotNull(),
                      F.array(F.col(f"{c}.lang"), F.col(f"{c}.prob").cast("string")))
    cols = [arr(c).alias(c) if c in ("lang_before", "lang_after") else F.col(c) for c in log.columns]
    return log.select(*cols)


JOB_ORIGIN = "job"


def write_log(log: DataFrame, path: str, origin=JOB_ORIGIN) -> str:
    """K2: one JSON line per document under ``year=/court=/origin=``; nulls written as null.

    ``origin`` is the job, or the name of the file that a backfill took the
    record from (a column): writing one replaces only its own records."""
    origin = origin if not isinstance(origin, str) else F.lit(origin)
    log = log_json(log.withColumn("origin", origin)).drop("file_name")
    return write_partitioned(log, path, ["year", "court", "origin"], "json", ignoreNullFields="false")


def write_curated(curated_docs: DataFrame, path: str) -> str:
    """K1: the curated documents (key, content / text) put by key under ``year=/court=/bench=/run=``: those
    of earlier runs stay, and of a key the later run's document."""
    return keyed.put(curated_docs, path, ["year", "court", "bench"])


def write_vectors(spark, vectors: DataFrame, path: str, version: str, current_version: str | None = None) -> str:
    """K3: keyed upsert of vector records per index; the later batch wins, inside a batch the newest
    decision (as a date), then the object key."""
    v = vectors.select("index_name", "key", "data", "metadata", "decision_date",
                       upsert_date(F.col("decision_date")).alias("upsert_date"), "s3_key")
    return upsert_table(spark, v, path, version, ["index_name", "key"], ["upsert_date", "s3_key"],
                        partition_by=["index_name"], current_version=current_version)


def write_items(spark, items: DataFrame, path: str, version: str, current_version: str | None = None) -> str:
    """K4: keyed upsert of metadata items on (pk, sk), in the order of K3."""
    dated = items.withColumn("upsert_date", upsert_date(F.col("decision_date")))
    return upsert_table(spark, dated, path, version, ["pk", "sk"], ["upsert_date", "s3_key"],
                        current_version=current_version)


def write_titles(titles: DataFrame, path: str) -> str:
    """K5: titles as rows under P4's court path; the court's code keeps nameless courts apart."""
    return write_partitioned(titles.withColumn("court_path", K.court_path_name(F.col("court_name"))), path, RUN_PATH)


def write_stats(stats: DataFrame, path: str) -> str:
    """K6: one JSON stats record per run."""
    stats = stats.withColumn("court_path", K.court_path_name(F.col("court_name")))
    return write_partitioned(stats, path, RUN_PATH, "json", ignoreNullFields="false")


def write_objects_bucketed(objects: DataFrame, table: str, buckets: int, key_col: str = "key") -> str:
    """Store document text as a catalog table bucketed and sorted by object key.

    Stage 2's lookup joins metadata records to stored objects on the key; with
    the text side bucketed by that key the join reads it in place and only the
    (small, text-free) metadata side is shuffled to meet it.
    """
    (objects.write.mode("overwrite").bucketBy(buckets, key_col).sortBy(key_col)
     .format("parquet").saveAsTable(table))
    return table
