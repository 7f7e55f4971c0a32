"""Stand-ins for the reference's inputs, derived from the driver tables.

The reference reads PDFs, OCR output and a metadata Parquet from object
stores. The catalogue queries run the same operators over tables derived
from the driver's tables, so the work grows with them:

* stage-1 documents   ``documents`` (text prefixed by a keyword chosen by
  ``doc_id % 7`` so every classifier rule fires; key = Hive-style path)
* repaired text       ``benchmark`` item ``doc_id % 48`` (ids past the table
  end find no row: the repair "failed")
* metadata records    ``documents`` LEFT JOIN ``orders`` on
  ``o_orderkey = doc_id`` with dates, links and case numbers in every shape
  the key derivation must handle
* stored objects      metadata keys of all but every 25th document, some with
  store, extraction or later errors
* page rows           ``conversations`` (conv_id, turn, text)

Every value here is built with the same expressions in the oracle SQL
(``plans/oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.functions.partitioning import spread

# FIXED VALUES — test parameters of the catalogue (stage 1 thresholds that
# make the gate fire on the synthetic corpus; chunk sizes that give many
# chunks per document).
TEST_MIN_RATIO = 0.75
TEST_ALLOWED = "en"
TEST_CHUNK_MAX = 200
TEST_CHUNK_OVERLAP = 40
TEST_EMBED_DIM = 64
REPAIR_ITEMS = 48

# FIXED VALUES — keyword prefixes, picked by doc_id % 7.
PREFIXES = ["JUDGMENT ", "ORDER ", "followingORDER: ", "HAVING HEARD ", "निर्णय ", "आदेश ", ""]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ext(doc_id, mixed: bool) -> F.Column:
    upper = F.when(doc_id % 9 == 0, F.lit(".PDF"))
    return (upper.when(doc_id % 9 == 1, F.lit(".txt")) if mixed else upper).otherwise(F.lit(".pdf"))


def stage1_objects(spark: SparkSession, sf_dir: str, mixed: bool = False) -> DataFrame:
    """Listing of the stage-1 store: key, year, court, bench, doc_id, text, lang. Every document is a
    ``.pdf`` or ``.PDF``; in a ``mixed`` listing every ninth is a ``.txt`` that the scan must pass over."""
    d = spread(table(spark, sf_dir, "documents"))
    year = (F.lit(1995) + F.col("doc_id") % 5).cast("string")
    prefix = F.element_at(F.array(*[F.lit(p) for p in PREFIXES]), (F.col("doc_id") % 7 + 1).cast("int"))
    return d.select(
        F.concat(F.lit("data/pdf/year="), year, F.lit("/court="), F.col("source"),
                 F.lit("/bench="), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"),
                 _ext(F.col("doc_id"), mixed)).alias("key"),
        year.alias("year"), F.col("source").alias("court"), F.col("lang").alias("bench"),
        "doc_id", F.concat(prefix, F.col("text")).alias("text"), "lang",
    )


def repaired_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, text, lang): the repaired text of each stage-1 object, when the repair produced one. It reads as
    English for even ids, and in the object's own language (which the gate may refuse) for odd ones."""
    objs = stage1_objects(spark, sf_dir).select("key", "doc_id", "lang")
    b = table(spark, sf_dir, "benchmark")
    return objs.join(b, (objs.doc_id % REPAIR_ITEMS) == b.item_id).select(
        "key", b.text.alias("text"), F.when(F.col("doc_id") % 2 == 0, F.lit("en")).otherwise(F.col("lang")).alias("lang"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata records partitioned by (year, court_code, bench)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = d.join(o, d.doc_id == o.o_orderkey, "left")
    i = F.col("doc_id")
    od = F.col("o_orderdate")
    decision = (
        F.when(i % 11 == 0, F.lit(None).cast("string"))
        .when(i % 11 == 1, F.lit(""))
        .when(i % 11 == 2, F.date_format(od, "dd-MM-yyyy"))
        .when(i % 11 == 3, F.concat_ws("-", F.year(od), F.month(od), F.dayofmonth(od)))
        .otherwise(F.date_format(od, "yyyy-MM-dd"))
    )
    link = (
        F.when(i % 23 == 0, F.concat(F.lit("links/"), F.col("source"), F.lit("/")))
        .when(i % 29 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("links/"), F.col("source"), F.lit("/"), i.cast("string"), F.lit(".pdf")))
    )
    cnr = (
        F.when(i % 17 == 0, F.lit(None).cast("string"))
        .when(i % 19 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("CNR"), F.floor(i / 2).cast("string")))
    )
    return j.select(
        F.coalesce(F.year(od).cast("string"), F.lit("None")).alias("year"),
        F.col("source").alias("court_code"),
        F.col("lang").alias("bench"),
        i.alias("doc_id"),
        cnr.alias("cnr"),
        F.when(i % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Case "), i.cast("string"))).alias("title"),
        F.concat(F.lit("High Court -- "), F.col("source")).alias("court"),
        decision.alias("decision_date"),
        od.cast("date").alias("date_of_registration"),
        link.alias("pdf_link"),
        F.concat(F.lit("<p>"), F.col("source"), F.lit("</p>")).alias("raw_html"),
        F.col("o_orderpriority").alias("priority"),
    )


def stored_objects(spark: SparkSession, sf_dir: str, keys: DataFrame) -> DataFrame:
    """(key, text, extract_error, fetch_error, general_error) for the metadata keys of all documents but
    those with doc_id % 25 = 7, which the store lacks.

    ``keys`` is (doc_id, key). One object per key (the lowest doc_id wins when
    two records derive the same key). Text is blank for doc_id % 31 = 0,
    extraction fails for doc_id % 37 = 0, the store answers with an error for doc_id % 41 = 0
    and a later step fails for doc_id % 43 = 0.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    # one object per key: pick the winning doc_id on keys only, then fetch its text
    winners = keys.where(F.col("doc_id") % 25 != 7).groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    i = F.col("doc_id")
    return winners.join(d, "doc_id").select(
        "key",
        F.when(i % 31 == 0, F.lit("")).otherwise(F.col("text")).alias("text"),
        F.when(i % 37 == 0, F.lit("unreadable page tree")).alias("extract_error"),
        F.when(i % 41 == 0, F.lit("access denied")).alias("fetch_error"),
        F.when(i % 43 == 0, F.lit("no space left")).alias("general_error"))


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, page_no, text) page rows."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("doc_key"), F.col("turn").cast("int").alias("page_no"), "text")
