"""Embeddings kept by the digest of their content, so that no content is paid for twice.

The store is a table (digest, data) under ``model=<name>``, only ever appended to. Chunks are
matched with it by the SHA-256 of their content; of the contents that it lacks each is embedded
once, however many chunks have it, and appended before anything reads it. A chunk that can't be
embedded (null) isn't stored and is tried again by the next run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.operators.lookup import look_up, one_row_a_key
from lexcurate.sources.files import exists

SCHEMA = "digest binary, data array<float>"


def digest(content: str = "content"):
    return F.unhex(F.sha2(F.col(content), 256))


def stored(spark: SparkSession, path: str, model: str) -> DataFrame:
    """(digest, data) of one model."""
    folder = f"{path.rstrip('/')}/model={model}"
    return spark.read.schema(SCHEMA).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], SCHEMA)


def add_missing(chunks: DataFrame, embedder, path: str, model: str) -> None:
    """Embeds the contents of ``chunks`` (digest, content) that the store lacks, each once, and appends them."""
    spark = chunks.sparkSession
    known = stored(spark, path, model).select("digest")
    lacking = chunks.where(F.col("content").isNotNull()).join(known, "digest", "left_anti")
    once = lacking.groupBy("digest").agg(F.any_value("content").alias("content"))  # copies are combined in their tasks
    fresh = once.select("digest", embedder(F.col("content")).alias("data"))
    fresh.where(F.col("data").isNotNull()).write.mode("append").parquet(f"{path.rstrip('/')}/model={model}")


def embedded(chunks: DataFrame, embedder, path: str, model: str = "default", data_col: str = "data") -> DataFrame:
    """``chunks`` with their embeddings as ``data_col``; null where the content can't be embedded."""
    chunks = chunks.withColumn("digest", digest())
    add_missing(chunks.select("digest", "content"), embedder, path, model)
    kept = one_row_a_key(stored(chunks.sparkSession, path, model), "digest")  # two runs at a time may both add one
    return look_up(chunks, kept.withColumnRenamed("data", data_col), "digest").drop("digest")
