"""Shared helpers of the training-data operators: scratch tables, row keys, labels.

Every intermediate table lives under the folder the session names in
``spark.checkpoint.dir``; nothing is written to a machine-local folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.session import scratch_path

#: Rows and bytes of one Arrow batch. Texts may be long; a batch of them must fit a Python worker.
BATCH_ROWS, BATCH_BYTES = 256, 4 << 20
#: The key column of documents, and the largest side (narrow rows, at most 64 bytes each) that is broadcast.
KEY, BROADCAST_ROWS = "__key", 250_000
#: Scratch folders written so far.
_SCRATCH: list[tuple[SparkSession, str]] = []


def configure(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    _SCRATCH.append((spark, path))
    return path


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder for a pipeline stage's output; it isn't dropped with the scratch tables."""
    return scratch_path(spark, f"stage-{name}-{uuid.uuid4().hex}")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and
    a lost executor re-reads files instead of repeating the lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def made_by(make):
    """What ``make()`` returns, and the scratch folders written meanwhile."""
    before = len(_SCRATCH)
    return make(), _SCRATCH[before:]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique non-null key column ``__key``.

    The key is doc_id where that is unique and never null. Otherwise (repeated
    or null ids) the rows get a surrogate, fixed by writing them once.
    """
    if KEY in docs.columns:
        return docs
    n, known = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    if n == known and not docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return docs.withColumn(KEY, F.col("doc_id").cast("long"))
    return table(docs.withColumn(KEY, F.monotonically_increasing_id()), "keyed")


def texts(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, text) of keyed documents; null text is empty."""
    return keyed(docs).select(F.col(KEY).alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"),
                              F.coalesce("text", F.lit("")).alias("text"))


def sized(df: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (narrow rows, materialised) broadcast if it has at most ``most_rows`` rows; else left to a shuffled join."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of keyed ``docs`` whose key isn't in ``dropped`` (row_key), without the key column."""
    gone = sized(table(dropped.select(F.col("row_key").alias(KEY)), "dropped"))
    return docs.join(gone, KEY, "left_anti").drop(KEY)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: (node, root) with root the smallest node of each
    component, for every node on an edge.

    Hook and contract: every component hooks to its smallest neighbour, the
    forest is flattened by pointer jumping, edges are relabelled and
    inner ones dropped, until none is left. Every round at least halves the
    components with an open edge. All steps are keyed joins or map-side
    combined minima; each round is written to the shared folder.
    """
    spark = edges.sparkSession
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    open_edges = table(edges, "edges")
    labels = table(open_edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                   .select("node", F.col("node").alias("root")), "labels")
    while not open_edges.isEmpty():
        both = open_edges.select("a", "b").union(open_edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                       .select("node", F.least("node", "low").alias("up")), "hooks")
        while True:
            once = parent.join(parent.select(F.col("node").alias("up"), F.col("up").alias("two")), "up").select("node", F.col("two").alias("up"))
            jumped = table(once.join(once.select(F.col("node").alias("up"), F.col("up").alias("four")), "up")
                           .select("node", F.col("four").alias("up"), (F.col("four") != F.col("up")).alias("moved")), "jumps")
            parent = jumped.select("node", "up")  # every "up" is a node itself, so inner joins lose none
            if jumped.where("moved").isEmpty():
                break
        roots = parent.select(F.col("node").alias("root"), F.col("up").alias("top"))
        labels = table(labels.join(roots, "root", "left").select("node", F.coalesce("top", "root").alias("root")),
                       "labels")
        ends = open_edges
        for end in ("a", "b"):
            ends = (ends.join(parent.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up")), end, "left")
                    .withColumn(end, F.coalesce(f"{end}_up", end)).drop(f"{end}_up"))
        open_edges = table(ends.where("a <> b").select("a", "b").distinct(), "edges")
    return labels
