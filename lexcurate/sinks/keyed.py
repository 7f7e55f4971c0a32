"""K1: a partitioned store that documents are put into by key.

A batch replaces the documents whose keys it holds and leaves all others. Only files that
hold one of its keys are rewritten (copy on write): the key column of the store is its
index, read without any text and semi-joined with the batch's keys. What else such a file
holds is written again beside the batch, under ``run=<id>`` of the partition, and the
old file goes.

Readers see plain Parquet partitions. A run leaves a journal while it works: the files it is
to replace, then a mark that the new ones are complete. A run that broke off before
the mark is undone by the next one, one that broke off after it is finished, so no
document is lost or doubled, and repeating a run gives the same store.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.sources.files import delete, exists, glob

#: Folder of the journal (Spark's readers pass over names with an underscore), and the partition that names the run.
JOURNAL, RUN = "_journal", "run"


def recover(spark: SparkSession, path: str, partition_by: list[str]) -> None:
    """Finishes or undoes what a run that broke off has left."""
    for run_folder in glob(spark, f"{path}/{JOURNAL}/*"):
        run = run_folder.rstrip("/").rsplit("/", 1)[-1]
        if exists(spark, f"{run_folder}/published"):
            _drop_replaced(spark, run_folder)
        else:
            for folder in glob(spark, f"{path}/{'*/' * len(partition_by)}{RUN}={run}"):
                delete(spark, folder)
        delete(spark, run_folder)


def _drop_replaced(spark: SparkSession, run_folder: str) -> None:
    for row in spark.read.schema("file string").parquet(f"{run_folder}/replaced").collect():  # names of the touched files
        delete(spark, row.file)


def put(batch: DataFrame, path: str, partition_by: list[str], key: str = "key") -> str:
    """Writes ``batch`` (unique keys) into the store at ``path``."""
    spark, path, run = batch.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    recover(spark, path, partition_by)
    on = [*partition_by, key]
    batch = batch.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in partition_by})
    journal = f"{path}/{JOURNAL}/{run}"
    rows, replaced = batch, []
    if glob(spark, f"{path}/{'*/' * len(partition_by)}{RUN}=*"):
        keys = batch.select(*on)
        held = spark.read.parquet(path)
        index = held.select(*on, F.col("_metadata.file_path").alias("file"))
        replaced = [r.file for r in index.join(keys, on, "left_semi").select("file").distinct().collect()]  # names, no rows
        if replaced:
            others = spark.read.option("basePath", path).schema(held.schema).parquet(*replaced).join(keys, on, "left_anti")
            rows = others.drop(RUN).unionByName(batch, allowMissingColumns=True)
    spark.createDataFrame([(f,) for f in replaced], "file string").coalesce(1).write.parquet(f"{journal}/replaced")
    rows.hint("rebalance", *partition_by).withColumn(RUN, F.lit(run)).write.mode("append").partitionBy(*partition_by, RUN).parquet(path)
    spark.createDataFrame([(run,)], "run string").coalesce(1).write.parquet(f"{journal}/published")
    _drop_replaced(spark, journal)
    delete(spark, journal)
    return path
