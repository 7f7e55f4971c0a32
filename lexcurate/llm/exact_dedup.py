"""Exact dedup by stateful streaming, in DataFrame operations only.

Documents become narrow rows (digest of the normalised text, code points,
identifier, locator), written once. A structured stream over them keeps one
state entry a digest, without expiry, in the disk-backed RocksDB store: the
row that stays (stable identifier and content locator) and the group's size.
Tasks combine the rows of a digest before the shuffle, so a hot digest is one
row a task. The final state is read back from the stream's checkpoint.

A digest hit is not yet a copy: full texts of the groups with more than one
member are compared with the text of the row that stays. If any differs, the
groups of that digest are formed anew from whole texts.

Defined cases: null text is empty, and empty texts are equal; the
normalisation removes every white-space character of ``[\\x20\\x09-\\x0D]``;
of rows with repeated ids only one is kept; a null id orders after all
others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.llm import common

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Preallocated log files would take several MB for each partition of the state.
PREALLOCATE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
#: MB of a partition's write buffer. Its memory comes in blocks of an eighth, 1 MB of the default's, and an executor holds many partitions.
BUFFER, BUFFER_MB = "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB", 2
#: Files of narrow rows that one micro-batch takes.
FILES_A_BATCH = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")


def order() -> Column:
    """Greatest for the row that stays: most code points, then smallest id (complement: no overflow), then key."""
    return F.struct("points", F.bitwise_not(F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("low_id"),
                    F.bitwise_not("row_key").alias("low_key"))


@contextmanager
def _rocksdb(spark: SparkSession):
    wanted = {PROVIDER: ROCKSDB, PREALLOCATE: "false", BUFFER: str(BUFFER_MB)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def digest_state(rows: DataFrame, path: str, files_a_batch: int = FILES_A_BATCH) -> DataFrame:
    """State of the stream over the narrow rows at ``path``: digest, group_size, keep_key, keep_id, keep_file."""
    spark = rows.sparkSession
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)
    best = stream.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct(order().alias("o"), "doc_id", "file")).alias("best"))
    checkpoint = common.scratch(spark, "digest-state")
    with _rocksdb(spark):
        best.writeStream.format("noop").outputMode("update").trigger(availableNow=True) \
            .option("checkpointLocation", checkpoint).start().awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        buffers = state.schema["value"].dataType.names  # one a function, in the order of agg()
        kept = F.col(f"value.`{buffers[1]}`")
        return common.table(state.select(
            F.col("key.digest").alias("digest"), F.col(f"value.`{buffers[0]}`").alias("group_size"),
            F.bitwise_not(kept["o"]["low_key"]).alias("keep_key"), kept["doc_id"].alias("keep_id"),
            kept["file"].alias("keep_file")), "digests")


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = lambda sha: sha) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, keep_file (where the
    kept row lies), row_key. ``digest``: the state's key, made from the SHA-256 (tests weaken it)."""
    spark = docs.sparkSession
    texts = common.texts(docs)
    sha = F.sha2(normalised(F.col("text")), 256)
    path = common.scratch(spark, "narrow")
    narrow = texts.select("row_key", "doc_id", sha.alias("text_sha256"), F.length("text").alias("points"),
                          F.input_file_name().alias("file")).withColumn("digest", digest(F.col("text_sha256")))
    narrow.write.parquet(path)
    rows = spark.read.schema(narrow.schema).parquet(path)
    if rows.isEmpty():
        return _result(rows.select("*", F.lit(1).cast("long").alias("group_size"), F.col("row_key").alias("keep_key"),
                                   F.col("doc_id").alias("keep_id"), F.col("file").alias("keep_file")))
    state = digest_state(rows, path)
    joined = rows.drop("file").join(state, "digest")

    hits = common.sized(state.where("group_size > 1").select("digest", "keep_key"))
    full = common.table(texts.select("row_key", normalised(F.col("text")).alias("normal"), digest(sha).alias("digest"))
                        .join(hits, "digest"), "hits")
    keeper = full.where("row_key = keep_key").select("digest", F.col("normal").alias("keeper"))
    # no aggregate above this join: then Spark can split a hot digest's partition
    differ = common.table(full.join(keeper, "digest").where("normal <> keeper").select("digest"), "differ")
    if differ.isEmpty():
        return _result(joined)
    odd = common.table(differ.distinct(), "odd")

    # texts that share a digest without being equal: group those by the whole text
    mixed = full.join(odd, "digest", "left_semi").select("row_key", "normal").join(
        rows.select("row_key", "doc_id", "points", "text_sha256", "digest", "file"), "row_key")
    groups = mixed.groupBy("normal").agg(F.count(F.lit(1)).alias("group_size"),
                                         F.max(F.struct(order().alias("o"), "doc_id", "file")).alias("best"))
    apart = mixed.join(groups, "normal").select(
        "row_key", "doc_id", "text_sha256", "group_size", F.bitwise_not(F.col("best.o.low_key")).alias("keep_key"),
        F.col("best.doc_id").alias("keep_id"), F.col("best.file").alias("keep_file"))
    return _result(joined.join(odd, "digest", "left_anti")).unionByName(_result(apart))


def _result(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "keep_id", F.col("group_size").cast("long"), (F.col("row_key") == F.col("keep_key")).alias("kept"),
                       "text_sha256", "keep_file", "row_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat another's text."""
    docs = common.keyed(docs)
    return common.without(docs, exact_dedup(docs).where("NOT kept"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(common.documents(spark, sf_dir))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP5_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]', '', 'g') AS normal FROM documents),
g AS (SELECT doc_id, normal, count(*) OVER (PARTITION BY normal) AS group_size,
             first_value(doc_id) OVER (PARTITION BY normal ORDER BY length(text) DESC, doc_id) AS keep_id FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normal) AS text_sha256 FROM g
"""
