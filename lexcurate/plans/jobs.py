"""E1, E2, M1, K7 as batch jobs with sinks.

Each run writes its stage tables once, to a folder of its own under the output
root, and derives every sink from them, so text is scored, chunked and embedded
once, not once per sink, a lost executor recomputes at most the stage, and a
run never reads, embeds or counts what an earlier run left under the same root. Output paths are partitioned by year / court /
bench and written with dynamic partition overwrite: a rerun of the same
partitions replaces exactly them.
"""

from __future__ import annotations

import datetime
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.functions.keys import year_from_log_name
from lexcurate.operators import quality, sentence_model, stats
from lexcurate.operators.broadcast import broadcast_if_small, materialize
from lexcurate.operators.sentence_model import SentenceModel
from lexcurate.plans import indexing, ledger
from lexcurate.sinks import writers
from lexcurate.sources.files import delete
from lexcurate.sources.metadata import FILE, list_files, partition_glob, partition_of, read_metadata, short_files
from lexcurate.sources.readers import read_logs


def stage1_documents(spark: SparkSession, pdf_root: str, pages: DataFrame, *, year=None, court=None,
                     year_range: tuple[int, int] | None = None, page_key_col: str = "doc_key") -> DataFrame:
    """S1 + S2 + S4: the PDF objects of the selected partitions with their text.

    Objects are listed with partition pruning (no bytes read); their text is
    the newline-joined non-empty pages of the page table, keyed by the object
    key relative to ``pdf_root`` (``data/pdf/year=.../x.pdf``). An object
    without extracted pages gets empty text (the extractor's answer for an
    unreadable file), so it is garbled and goes to repair. Spark's file
    sources do not list zero-byte files, so an empty object has no row.
    """
    from lexcurate.sources.readers import assemble_pages, pdf_objects

    objs = pdf_objects(spark, pdf_root, year=year, court=court, year_range=year_range, with_content=False)
    rel = F.regexp_extract(F.col("path"), r"(data/pdf/.*)$", 1)
    objs = objs.select(F.when(rel != "", rel).otherwise(F.col("path")).alias("key"), "year", "court",
                       *(["bench"] if "bench" in objs.columns else [F.lit(None).cast("string").alias("bench")]))
    # only the pages of the listed objects are grouped
    listed = objs.select(F.col("key").alias(page_key_col)).distinct()
    text = assemble_pages(pages.join(listed, page_key_col, "left_semi"), key_col=page_key_col, sep="\n", drop_empty=True) \
        .withColumnRenamed(page_key_col, "key")
    return (objs.join(text, "key", "left")
            .select("key", "year", "court", "bench", F.coalesce(F.col("text"), F.lit("")).alias("text")))


@dataclass
class CurationOutput:
    log_path: str
    curated_path: str


def run_curation(spark: SparkSession, documents: DataFrame, out_root: str, detector,
                 repaired: DataFrame | None = None, *, min_ratio: float = quality.DEFAULT_MIN_WORD_RATIO,
                 allowed_langs: str = quality.DEFAULT_ALLOWED_LANGS, lexicon: str = "latin",
                 fix_fused: bool = False, classify_on: str = "before", fetch_error_col: str | None = None,
                 freq: DataFrame | None = None, upload_error_col: str | None = None, uploader=None) -> CurationOutput:
    """E1 over ``documents`` (key, year, court, bench, text [, fetch error, upload error, content]).

    Writes the per-document log (K2, JSON lines under year=/court=) and the
    curated documents (K1, under year=/court=/bench=). One log row per input.
    A repaired document is stored as repaired: its text (and, where ``repaired``
    has them, its bytes) replace the garbled ones.
    ``uploader``: a function from a column (struct of a curated document's columns) to a column, called once for each curated document as it
    is copied; where it answers with an error the document's status is ``upload_failed: ...`` and the store has no copy of it.
    """
    out = out_root.rstrip("/")
    # assembled texts: written once as columns, read by every score and by the copy, dropped at the end
    texts = f"{out}/stage/run={uuid.uuid4().hex}/documents"
    documents.write.parquet(texts)
    documents = spark.read.schema(documents.schema).parquet(texts)
    log = quality.assess(documents, detector, repaired, min_ratio=min_ratio, allowed_langs=allowed_langs,
                         lexicon=lexicon, fix_fused=fix_fused, classify_on=classify_on,
                         fetch_error_col=fetch_error_col, keep=("year", "court", "bench"), freq=freq,
                         upload_error_col=upload_error_col)
    # stage table: this run's log, written once (parquet keeps structs exact)
    stage = f"{out}/stage/run={uuid.uuid4().hex}/log"
    log.write.parquet(stage)
    log = spark.read.parquet(stage)
    copies = curated_documents(documents, log, repaired)
    if uploader:
        # answers are written once, beside their documents: no document is uploaded again to write the log or the store
        answered = f"{stage[:-len('/log')]}/uploads"
        copies.withColumn("__error", uploader(F.struct(*copies.columns))).write.parquet(answered)
        answers = spark.read.parquet(answered)
        errors = answers.where(F.col("__error").isNotNull()).select("key", "__error")
        log = log.join(errors, "key", "left").withColumn("status", F.coalesce(
            F.concat(F.lit(quality.UPLOAD_FAILED), F.col("__error")), F.col("status"))).select(*log.columns)
        copies = answers.where(F.col("__error").isNull()).drop("__error")
    writers.write_log(log, f"{out}/logs")
    writers.write_curated(copies, f"{out}/curated")
    delete(spark, texts)
    return CurationOutput(f"{out}/logs", f"{out}/curated")


def curated_documents(documents: DataFrame, log: DataFrame, repaired: DataFrame | None = None) -> DataFrame:
    """K1 rows: key, year, court, bench, text [, content] of the documents that pass the curation gate;
    of a repaired one what the repair gave."""
    keys = quality.curated(log).select("key", "did_ocr")
    payload = ["content"] if "content" in documents.columns else []  # the object bytes, when scanned
    cols = ["key", "year", "court", "bench", "text", *payload]
    kept = documents.join(broadcast_if_small(keys.where("NOT did_ocr").select("key")), "key", "left_semi").select(*cols)
    if repaired is None:
        return kept
    mended = broadcast_if_small(keys.where("did_ocr").select("key"))
    fresh = [c for c in ("text", *payload) if c in repaired.columns]
    rep = quality.one_repair(repaired.select("key", *fresh).join(mended, "key", "left_semi"))
    rest = documents.join(mended, "key", "left_semi").select(*[c for c in cols if c not in fresh])
    return kept.unionByName(rest.join(rep, "key"))


@dataclass
class IndexingOutput:
    stage_path: str
    vectors_path: str
    items_path: str
    rejects_path: str
    titles_path: str
    stats_path: str
    failed_path: str


def run_indexing(spark: SparkSession, meta: DataFrame, objects: DataFrame, out_root: str, version: str, *,
                 current_version: str | None = None, embedder=None, max_tokens: int = 2000,
                 overlap: int = 100, embedding_store: str | None = None, model: str = "default",
                 sentences: SentenceModel | None = None) -> IndexingOutput:
    """E2 over metadata records of any number of runs and the stored objects.

    ``embedding_store``: a folder of embeddings by content and ``model``; contents that it holds aren't embedded again.
    ``sentences``: a trained sentence model; without one sentences end after every ``. ! ?`` before white space."""
    started = time.time()
    # Run identity and times, written with the statistics (not compared)
    process_id = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    processing_date = datetime.datetime.now().isoformat()
    out = out_root.rstrip("/")
    stage_path = f"{out}/stage/run={process_id}/records"
    splitter = {"splitter": lambda text: sentence_model.sentences(text, sentences)} if sentences else {}
    stage = indexing.lookup_and_chunk(meta, objects, max_tokens=max_tokens, overlap=overlap, **splitter)
    stage.write.parquet(stage_path)  # read whole by this run: not partitioned, so a task writes one file
    stage = spark.read.parquet(stage_path)

    res = indexing.derive(stage, list(meta.columns), embedder, embedding_store, model)
    # embedded chunks are the second stage table: vectors and error counts read it
    chunks_path = f"{out}/stage/run={process_id}/chunks"
    res.chunks.write.parquet(chunks_path)
    chunks = spark.read.parquet(chunks_path)
    vectors = chunks.where(F.col("data").isNotNull() & F.col("has_cnr"))

    vectors_path = writers.write_vectors(spark, vectors, f"{out}/vectors", version, current_version)
    items_path = writers.write_items(spark, res.items, f"{out}/items", version, current_version)
    rejects_path = f"{out}/rejects"
    writers.write_partitioned(res.rejects, rejects_path, indexing.RUN_KEYS)
    titles_path = writers.write_titles(stats.titles(res.records), f"{out}/titles")
    failed_path = f"{out}/failed_files"
    writers.write_partitioned(stats.failed_files(res.records), failed_path, indexing.RUN_KEYS)
    ended = time.time()
    run = stats.run_stats(res.records, chunks).select(
        "*", F.lit(process_id).alias("process_id"), F.lit(processing_date).alias("processing_date"),
        F.lit(started).alias("start_time"), F.lit(ended).alias("end_time"),
        F.lit(ended - started).alias("total_processing_time_seconds"))
    stats_path = writers.write_stats(run, f"{out}/stats")
    return IndexingOutput(stage_path, vectors_path, items_path, rejects_path, titles_path, stats_path, failed_path)


def run_years(spark: SparkSession, metadata_root: str, objects: DataFrame, out_root: str, version: str,
              first_year: int, last_year: int, court_code=None, bench=None, court_dir: str = "court",
              file_glob: str | None = "*metadata.parquet", resume: bool = False, **kw) -> IndexingOutput | None:
    """M1 + M2: every year of a court (and bench) in one job; results grouped by run.

    A bad record never fails the job: it becomes an outcome row. Nor does a bad file: its partition is
    left out and is ``failed`` in the ledger (``plans.ledger``), all others run. ``resume=True`` takes
    only the partitions that the ledger doesn't call finished; None if there are none.
    """
    out = out_root.rstrip("/")
    run = uuid.uuid4().hex
    files = list_files(spark, partition_glob(metadata_root, None, court_code, bench, (first_year, last_year), court_dir), file_glob)
    if resume:
        done = {tuple(r) for r in ledger.states(spark, out).where(F.col("state") == ledger.FINISHED).select(*ledger.KEYS).collect()}
        files = [f for f in files if partition_of(f, court_dir) not in done]
    if not files:
        return None
    partitions = spark.createDataFrame(sorted({partition_of(f, court_dir) for f in files}), "year string, court_code string, bench string")
    ledger.append(spark, out, run, partitions, ledger.STARTED)
    scan = read_metadata(spark, metadata_root, paths=files, court_dir=court_dir)
    broken = scan.unreadable
    output = None
    if scan.records is not None:
        # read once: a file may prove to be short only now, and later reads are of what was checked
        path = f"{out}/stage/metadata={run}"
        scan.records.write.parquet(path)
        records = spark.read.schema(scan.records.schema).parquet(path)
        broken = materialize(broken.unionByName(short_files(spark, records, scan.files, court_dir)))
        sound = records.join(F.broadcast(broken.select(*ledger.KEYS).distinct()), ledger.KEYS, "left_anti").drop(FILE)  # at most a row a file
        output = run_indexing(spark, sound, objects, out_root, version, **kw)
        counts = sound.groupBy(*ledger.KEYS).agg(F.count(F.lit(1)).alias("records"))
        finished = partitions.join(broken, ledger.KEYS, "left_anti").join(counts, ledger.KEYS, "left")
        ledger.append(spark, out, run, finished.fillna(0, ["records"]), ledger.FINISHED)
    ledger.append(spark, out, run, broken, ledger.FAILED)
    return output


def backfill_logs(spark: SparkSession, log_glob: str, out_root: str) -> str:
    """K7: log files written outside the job -> the log layout, year from the
    file name (``.jsonl`` names only), court from each record's key. Each file's
    records lie in a partition of their own, named by the file and a digest of its folder, so a backfill replaces only what
    the same file gave before."""
    logs = read_logs(spark, log_glob).where(F.col("file_name").endswith(".jsonl"))
    court = F.regexp_extract(F.col("key"), r"/court=([^/]+)/", 1)
    logs = logs.select(
        "key", "status", "word_ratio_before", "lang_before", "word_ratio_after", "lang_after", "did_ocr", "doc_type",
        year_from_log_name(F.col("file_name")).alias("year"),
        F.when(court != "", court).otherwise(F.lit("unknown")).alias("court"), "file_name",
        F.substring(F.md5(F.regexp_replace("file_path", "/[^/]*$", "")), 1, 8).alias("folder"))
    return writers.write_log(logs.withColumn("file_name", F.concat("file_name", F.lit("-"), "folder")).drop("folder"),
                             f"{out_root.rstrip('/')}/logs", origin=F.col("file_name"))
