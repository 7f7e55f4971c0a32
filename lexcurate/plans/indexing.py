"""Metadata -> object key -> lookup -> text -> chunks -> vectors / items / stats.

One job covers any set of (year, court_code, bench) partitions: every record
carries its run keys, and results are grouped by run, so many runs (M1) are
one plan, not a loop.

Per record outcome (one value each):
  skipped               F2 (not counted anywhere)
  key_not_found         J1 anti side (neither success nor failure)
  error_with_getting_file  the store refused the object for another reason
  pdf_extraction_error  the stored object could not be read
  general_error         a later step of the document failed
  empty_text            text blank after trim
  success               counted tokens, chunked, embedded, item written

Shuffles: the metadata rows (no text) meet the stored objects once, on the
object key (``operators.lookup``: keys that many records name are dealt over all tasks). The run header (court name of the run) is a map-side partial
``min`` per run, joined back as a tiny table; text never moves again after
the lookup join: chunking, embedding and vector records are per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.functions import keys as K
from lexcurate.functions.text import is_blank, sentences, token_count
from lexcurate.operators import chunking, metadata as M
from lexcurate.operators import embedding_store
from lexcurate.operators.broadcast import broadcast_if_small, materialize
from lexcurate.operators.embedding import hashing_embedder, vector_records
from lexcurate.operators.lookup import look_up, one_row_a_key
from lexcurate.operators.upsert import upsert_date
from lexcurate.sources.metadata import DECISION_YEAR

RUN_KEYS = ["year", "court_code", "bench"]


# FIXED VALUES — per-document outcomes and failure labels / messages.
SKIPPED = "skipped"
KEY_NOT_FOUND = "key_not_found"
FETCH_ERROR = "error_with_getting_file"
EXTRACTION_ERROR = "pdf_extraction_error"
GENERAL_ERROR = "general_error"
EMPTY_TEXT = "empty_text"
SUCCESS = "success"
FAILURES = (FETCH_ERROR, EXTRACTION_ERROR, EMPTY_TEXT, GENERAL_ERROR)
EMPTY_TEXT_MESSAGE = "No extractable text found in PDF"


@dataclass
class IndexingResult:
    records: DataFrame   # one row per metadata record, with outcome
    chunks: DataFrame    # one row per chunk of a successful document
    vectors: DataFrame   # one row per embedded chunk with a case number
    items: DataFrame     # accepted metadata items
    rejects: DataFrame   # items refused for a missing case number


def keyed_records(meta: DataFrame, decision_type: str | None = None) -> DataFrame:
    """P2 + P3 + F2 on metadata records: adds year_val, filename, s3_key, skipped.

    ``raw_html`` is in no output, so it leaves here and is never read."""
    meta = meta.drop("raw_html")
    dtype = decision_type or meta.schema["decision_date"].dataType.typeName()
    dtype = {"date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp"}.get(dtype, "string")
    year_val = K.key_year(F.col("decision_date"), F.col("year"), dtype)
    if DECISION_YEAR in meta.columns:  # files that type the date differently: a typed one's year comes from the date itself
        year_val = F.coalesce(F.col(DECISION_YEAR), year_val)
    fname = K.file_name(F.col("pdf_link"))
    return meta.select(
        "*",
        year_val.alias("year_val"),
        fname.alias("filename"),
        K.object_key(year_val, F.col("court_code"), F.col("bench"), fname).alias("s3_key"),
        K.skip_link(F.col("pdf_link")).alias("skipped"),
    ).drop(DECISION_YEAR)


def run_header(meta: DataFrame) -> DataFrame:
    """Run keys -> court_name (P4 of the run's court; unknown-court when absent)."""
    court = F.col("court") if "court" in meta.columns else F.lit(None).cast("string")
    return meta.groupBy(*RUN_KEYS).agg(F.min(court).alias("__court")) \
        .select(*RUN_KEYS, K.court_name(F.col("__court")).alias("court_name"))


def lookup_and_chunk(meta: DataFrame, objects: DataFrame, *, max_tokens: int = chunking.DEFAULT_MAX_TOKENS,
                     overlap: int = chunking.DEFAULT_OVERLAP, counter=token_count,
                     object_key_col: str = "key", splitter=sentences) -> DataFrame:
    """The stage table: one row per metadata record with outcome, counts and
    the chunk array of a successful document (text itself is dropped). ``splitter``: T10, as a rule or a trained
    model (``operators.sentence_model``)."""
    recs = keyed_records(meta)
    # one row per run (years x courts x benches): counted, then broadcast, so
    # a run holding a third of all records is never shuffled onto one task
    header = broadcast_if_small(materialize(run_header(meta)))
    recs = recs.join(header, RUN_KEYS, "left")

    # errors of the store and of later steps, where the object rows carry them
    optional = {c: F.col(c) if c in objects.columns else F.lit(None).cast("string") for c in ("fetch_error", "general_error")}
    objs = one_row_a_key(objects.select(
        F.col(object_key_col).alias("s3_key"), F.col("text").alias("__text"), F.col("extract_error").alias("__extract_error"),
        optional["fetch_error"].alias("__fetch_error"), optional["general_error"].alias("__general_error")), "s3_key")
    looked = look_up(recs.where(~F.col("skipped")), objs.withColumn("__found", F.lit(True)), "s3_key")
    found = F.coalesce(F.col("__found"), F.lit(False))
    outcome = (F.when(~found, F.lit(KEY_NOT_FOUND))
               .when(F.col("__fetch_error").isNotNull(), F.lit(FETCH_ERROR))
               .when(F.col("__extract_error").isNotNull(), F.lit(EXTRACTION_ERROR))
               .when(is_blank(F.col("__text")), F.lit(EMPTY_TEXT))
               .when(F.col("__general_error").isNotNull(), F.lit(GENERAL_ERROR))
               .otherwise(F.lit(SUCCESS)))
    message = (F.when(outcome == FETCH_ERROR, F.concat(F.lit("Key not found: "), F.col("s3_key")))
               .when(outcome == EXTRACTION_ERROR, F.col("__extract_error"))
               .when(outcome == GENERAL_ERROR, F.col("__general_error"))
               .when(outcome == EMPTY_TEXT, F.lit(EMPTY_TEXT_MESSAGE)))
    ok = outcome == SUCCESS
    title = F.col("title") if "title" in meta.columns else F.col("filename")
    cnr = F.col("cnr") if "cnr" in meta.columns else F.lit(None).cast("string")

    carried = [c for c in recs.columns if c != "skipped"]
    if counter is token_count:
        # additive counter: the token count is the sum of the sentence counts
        # the chunk fold computes anyway (one pass over the text, not two)
        both = F.when(ok, chunking.chunks_and_tokens(F.col("__text"), max_tokens, overlap, counter, splitter))
        per_doc = [both["tokens"].alias("token_count"), both["chunks"].alias("chunks")]
    else:
        per_doc = [F.when(ok, counter(F.col("__text"))).alias("token_count"),
                   F.when(ok, chunking.chunk_array(F.col("__text"), max_tokens, overlap, counter, splitter)).alias("chunks")]
    docs = looked.select(
        *carried,
        outcome.alias("outcome"),
        message.alias("error_message"),
        title.alias("run_title"),
        M.has_cnr(cnr).alias("has_cnr"),
        *per_doc,
    )
    docs = docs.withColumn("chunk_count", F.when(F.col("outcome") == SUCCESS, F.size("chunks").cast("long")))
    skipped = recs.where(F.col("skipped")).select(*carried, F.lit(SKIPPED).alias("outcome"))
    return docs.unionByName(skipped, allowMissingColumns=True)


def derive(stage: DataFrame, meta_columns: list[str], embedder=None, store: str | None = None, model: str = "default") -> IndexingResult:
    """Records, embedded chunks, vectors and items from the stage table (a written one, where ``store`` is given: an
    embedding store that is asked before the embedder, and keeps what that gives)."""
    embedder = embedder or hashing_embedder()
    records = stage.drop("chunks")
    cnr = F.col("cnr") if "cnr" in stage.columns else F.lit(None).cast("string")
    # a vector's title is the record's own; the file name stands in only in the run's list of titles
    title = F.col("title") if "title" in stage.columns else F.lit(None).cast("string")
    chunks = stage.where(F.col("outcome") == SUCCESS).select(
        *RUN_KEYS, "court_name", "s3_key", cnr.alias("cnr"), title.alias("title"),
        F.col("year").alias("run_year"), "decision_date",
        upsert_date(F.col("decision_date")).alias("upsert_date"), "has_cnr",
        F.posexplode("chunks").alias("chunk_id", "content"),
    )
    if store:
        known = embedding_store.embedded(chunks, embedder, store, model, "__data")
        emb = vector_records(known, lambda content: F.col("__data"), court_col="court_name").drop("__data")
    else:
        emb = vector_records(chunks, embedder, court_col="court_name")
    vectors = emb.where(F.col("data").isNotNull() & F.col("has_cnr"))
    succeeded = records.where(F.col("outcome") == SUCCESS)
    items_all = M.items(succeeded.select(*[c for c in meta_columns if c not in ("s3_key", "raw_html", DECISION_YEAR)], "s3_key"))
    ok_cnr = M.has_cnr(F.col("pk"))
    return IndexingResult(records=records, chunks=emb, vectors=vectors,
                          items=items_all.where(ok_cnr), rejects=items_all.where(~ok_cnr))


def index(meta: DataFrame, objects: DataFrame, *, max_tokens: int = chunking.DEFAULT_MAX_TOKENS,
          overlap: int = chunking.DEFAULT_OVERLAP, embedder=None, counter=token_count,
          object_key_col: str = "key") -> IndexingResult:
    """Run stage 2 lazily over metadata records and the stored objects (key, text, extract_error)."""
    stage = lookup_and_chunk(meta, objects, max_tokens=max_tokens, overlap=overlap, counter=counter,
                             object_key_col=object_key_col)
    return derive(stage, list(meta.columns), embedder)
