"""Stage 1 over documents as they land, with Structured Streaming.

The reference re-runs stage 1 per year by hand. Here new document rows
(parquet files dropped into a landing folder: key, year, court, bench,
text, lang) are picked up by a file stream; each micro-batch runs the same
``quality.assess`` plan (stream-static join with the repaired-text table)
and writes its log rows and curated documents, each under the batch's id. The checkpoint folder records
which files were processed, so a restarted or failed query resumes without
reprocessing or losing documents; ``trigger(availableNow=True)`` drains the
backlog and stops, which is how a scheduled batch cluster would run it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexcurate.functions.partitioning import spread_by_key
from lexcurate.operators import quality
from lexcurate.plans.jobs import curated_documents

LANDING_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("court", T.StringType()),
    T.StructField("bench", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
])


def curation_stream(spark: SparkSession, landing: str, out_root: str, checkpoint: str, detector,
                    repaired: DataFrame | None = None, *, max_files_per_trigger: int = 1000,
                    available_now: bool = True, **assess_kw):
    """Start the streaming query; returns the ``StreamingQuery``."""
    out = out_root.rstrip("/")
    docs = (spark.readStream.schema(LANDING_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(landing))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # a file may be one row group, so one task: fewer files than cores are dealt out by row before they are scored
        scored = spread_by_key(batch, "key", max_files_per_trigger)
        log = quality.assess(scored, detector, repaired, keep=("year", "court", "bench"), **assess_kw)
        log = log.withColumn("batch_id", F.lit(batch_id))
        # idempotent per batch: a replayed batch overwrites its own partition
        (log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{out}/log"))
        written = spark.read.parquet(f"{out}/log").where(F.col("batch_id") == batch_id)
        (curated_documents(batch, written, repaired).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{out}/curated"))

    w = docs.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
