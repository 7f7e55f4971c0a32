"""Query catalogue over the driver tables: one entry per operator group.

Each function takes (spark, sf_dir) and returns a DataFrame whose columns are
named like the matching oracle SQL (``plans/oracle.py``). Every query reads
whole tables; the only filters are the operators' own predicates.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.functions import keys as K
from lexcurate.functions import text as TX
from lexcurate.functions.classify import doc_type
from lexcurate.functions.partitioning import spread
from lexcurate.operators import chunking, frequency, langid, quality, sentence_model, stats, upsert
from lexcurate.operators.broadcast import materialize, written
from lexcurate.operators.embedding import hashing_embedder
from lexcurate.plans import indexing, standins as SI
from lexcurate.sources.readers import assemble_pages

# --------------------------------------------------------------------------- stage 1

def _stage1_docs(spark, sf):
    """only ``.pdf`` keys (any case) are documents."""
    return SI.stage1_objects(spark, sf).where(K.is_pdf(F.col("key")))


def q_scan_partition(spark, sf):
    o = SI.stage1_objects(spark, sf, mixed=True)
    return o.select("key", "year", "court", "bench",
                    K.partition_prefix(F.col("year"), F.col("court")).alias("prefix"),
                    K.is_pdf(F.col("key")).alias("is_pdf"))


def q_store_scan(spark, sf):
    """S1 + S2 over files: the objects of 1996 to 1998 in a partitioned store of ``.pdf``, ``.PDF`` and ``.txt`` files, with their bytes.
    An object holds the texts of all documents of its partition, one a line."""
    from lexcurate.sources.readers import pdf_objects

    root, o = _scratch(spark), SI.stage1_objects(spark, sf, mixed=True)
    kind = F.regexp_extract("key", r"\.([^.]*)$", 1)
    line = F.concat(F.col("doc_id").cast("string"), F.lit(" "), F.base64(F.encode("text", "UTF-8")))
    lines = o.select(F.replace(line, F.lit("\r\n"), F.lit("")).alias("line"), "year", "court", "bench", kind.alias("kind")).repartition("year", "court", "bench")
    for name in ("pdf", "PDF", "txt"):
        lines.where(F.col("kind") == name).drop("kind").write.mode("append").option("extension", name).partitionBy("year", "court", "bench").csv(root)
    objects = pdf_objects(spark, root, year_range=(1996, 1998))
    text = F.explode(F.split(F.trim(F.decode("content", "UTF-8"), F.lit("\n")), "\n")).alias("line")
    rows = objects.select("year", "court", "bench", F.lower(F.regexp_extract("path", r"\.([^.]*)$", 1)).alias("kind"), text)
    return rows.select(F.substring_index("line", " ", 1).cast("long").alias("doc_id"), "year", "court", "bench", "kind",
                       F.decode(F.unbase64(F.substring_index("line", " ", -1)), "UTF-8").alias("text"))


def q_doc_type_latin(spark, sf):
    return _stage1_docs(spark, sf).select("key", doc_type(F.col("text"), "latin").alias("doc_type"))


def q_doc_type_multi(spark, sf):
    return _stage1_docs(spark, sf).select("key", doc_type(F.col("text"), "multi").alias("doc_type"))


def q_garble_gate(spark, sf):
    d = _stage1_docs(spark, sf)
    allowed = quality.parse_langs(SI.TEST_ALLOWED)
    ratio = TX.word_ratio_heuristic(F.col("text"))
    blank = TX.is_blank(F.col("text"))
    return d.select("key", ratio.alias("word_ratio"), F.col("lang"), blank.alias("blank"),
                    quality.garbled(ratio, F.col("lang"), blank, SI.TEST_MIN_RATIO, allowed).alias("garbled"))


def _document_log(spark, sf, lexicon="latin"):
    docs = _stage1_docs(spark, sf)
    rep = SI.repaired_text(spark, sf)
    return quality.assess(docs, langid.GivenLanguage("lang"), rep, min_ratio=SI.TEST_MIN_RATIO,
                          allowed_langs=SI.TEST_ALLOWED, lexicon=lexicon, keep=("year", "court", "bench"))


def _document_log_models(spark, sf):
    """Stage 1 with Spark-trained models: known-word ratio from a frequency list
    built on ``benchmark`` (T2/T2b) and trigram language detection trained on
    ``documents`` (T3/T3b)."""
    docs = _stage1_docs(spark, sf)
    rep = SI.repaired_text(spark, sf)
    det = langid.NaiveBayesDetector(_profiles(spark, sf))
    freq = frequency.frequency_list(SI.table(spark, sf, "benchmark"))
    return quality.assess(docs, det, rep, min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED,
                          keep=("year", "court", "bench"), freq=freq)


def q_document_log_models(spark, sf):
    log = _flat_log(_document_log_models(spark, sf))
    return log.withColumn("prob_before", F.round("prob_before", 6)).withColumn("prob_after", F.round("prob_after", 6))


def q_document_log_multi(spark, sf):
    return _flat_log(_document_log(spark, sf, lexicon="multi"))


def _flat_log(log: DataFrame) -> DataFrame:
    return log.select(
        "key", "status", "word_ratio_before",
        F.col("lang_before.lang").alias("lang_before"), F.col("lang_before.prob").alias("prob_before"),
        "word_ratio_after",
        F.col("lang_after.lang").alias("lang_after"), F.col("lang_after.prob").alias("prob_after"),
        "did_ocr", "doc_type")


def q_document_log(spark, sf):
    return _flat_log(_document_log(spark, sf))


def q_repair_status(spark, sf):
    log = _document_log(spark, sf)
    return log.groupBy("status", "did_ocr").agg(F.count(F.lit(1)).alias("n_docs"))


def q_failure_statuses(spark, sf):
    """T11 where some objects can't be fetched and the curated store refuses some copies."""
    docs = _stage1_docs(spark, sf).withColumns({
        "fetch": F.when(F.col("doc_id") % 41 == 0, F.lit("gone")), "upload": F.when(F.col("doc_id") % 13 < 5, F.lit("denied"))})
    log = quality.assess(docs, langid.GivenLanguage("lang"), SI.repaired_text(spark, sf), min_ratio=SI.TEST_MIN_RATIO,
                         allowed_langs=SI.TEST_ALLOWED, fetch_error_col="fetch", upload_error_col="upload", keep=("year", "court", "bench"))
    return log.select("key", "status", "word_ratio_before", F.col("lang_before.lang").alias("lang_before"), "did_ocr", "doc_type")


def q_curated(spark, sf):
    log = _document_log(spark, sf)
    return quality.curated(log).select("key", "year", "court", "bench", "status")


# --------------------------------------------------------------------------- text operators

def _documents(spark, sf):
    return spread(SI.table(spark, sf, "documents"))


def q_word_ratio(spark, sf):
    d = _documents(spark, sf)
    return d.select("doc_id", TX.word_ratio_heuristic(F.col("text")).alias("word_ratio"),
                    TX.word_count(F.col("text")).alias("word_count"))


def q_token_count(spark, sf):
    d = _documents(spark, sf)
    return d.select("doc_id", TX.token_count(F.col("text")).alias("token_count"))


def q_sentences(spark, sf):
    d = _documents(spark, sf)
    s = d.select("doc_id", F.posexplode(TX.sentences(F.col("text"))).alias("sentence_no", "sentence"))
    return s.select("doc_id", "sentence_no", "sentence", TX.token_count(F.col("sentence")).alias("tokens"))


def q_sentence_model(spark, sf):
    """T10's training: abbreviations, collocations and sentence starters of all documents."""
    return sentence_model.train(_documents(spark, sf)).withColumn("score", F.round("score", 3))


def q_sentences_trained(spark, sf):
    """T10 with the model trained on the same documents."""
    d = _documents(spark, sf)
    model = sentence_model.SentenceModel.of(sentence_model.train(d))
    return d.select("doc_id", F.posexplode(sentence_model.sentences("text", model)).alias("sentence_no", "sentence"))


def q_chunks(spark, sf):
    d = _documents(spark, sf)
    return chunking.chunk(d, "text", SI.TEST_CHUNK_MAX, SI.TEST_CHUNK_OVERLAP, keep=("doc_id",))


def q_chunk_embedding(spark, sf):
    """Non-zero entries of each chunk's hashed embedding (dim 64), as rows."""
    ch = q_chunks(spark, sf)
    emb = hashing_embedder(SI.TEST_EMBED_DIM)
    v = ch.select("doc_id", "chunk_id", emb(F.col("content")).alias("data"))
    e = v.select("doc_id", "chunk_id", F.posexplode("data").alias("bucket", "value"))
    return e.where(F.col("value") != 0).select(
        "doc_id", "chunk_id", "bucket", F.round(F.col("value").cast("double"), 6).alias("value"))


def q_pages_newline(spark, sf):
    return assemble_pages(SI.page_rows(spark, sf), sep="\n", drop_empty=True)


def q_pages_concat(spark, sf):
    return assemble_pages(SI.page_rows(spark, sf), sep="", drop_empty=False)


def q_word_freq(spark, sf):
    f = frequency.frequency_list(SI.table(spark, sf, "benchmark"))
    return f.select("token", "n", F.round("zipf", 6).alias("zipf"))


FREQUENT = 5.0  # a word in ten thousand


def q_frequent_words(spark, sf):
    """T2b with bounded counts: the words of all documents at or above a cut."""
    f = frequency.frequent_words(_documents(spark, sf), cut=FREQUENT, cells=1 << 12)
    return f.select("token", "n", F.round("zipf", 6).alias("zipf"), "total")


def q_word_ratio_freq(spark, sf):
    f = frequency.frequency_list(SI.table(spark, sf, "benchmark"))
    return frequency.word_ratio_freq(_documents(spark, sf), f)


def _profiles(spark, sf):
    return langid.train_profiles(_documents(spark, sf), "text", "lang")


def q_lang_profiles(spark, sf):
    return _profiles(spark, sf)


def q_detect_language(spark, sf):
    det = langid.NaiveBayesDetector(_profiles(spark, sf))
    out = det.detect(_documents(spark, sf), "doc_id", "text")
    return out.select("doc_id", "lang", F.round("prob", 6).alias("prob"))


# --------------------------------------------------------------------------- stage 2

def _keyed(spark, sf):
    return indexing.keyed_records(SI.metadata(spark, sf))


def _objects(spark, sf):
    keyed = _keyed(spark, sf).where(~F.col("skipped")).select("doc_id", F.col("s3_key").alias("key"))
    return SI.stored_objects(spark, sf, keyed)


def q_object_key(spark, sf):
    k = _keyed(spark, sf).where(~F.col("skipped"))
    return k.select("doc_id", "year", "court_code", "bench", "year_val", "filename", "s3_key")


def q_object_key_skip(spark, sf):
    return _keyed(spark, sf).where(F.col("skipped")).select("doc_id", "pdf_link")


def q_court_index_name(spark, sf):
    h = indexing.run_header(SI.metadata(spark, sf))
    return h.select(*indexing.RUN_KEYS, "court_name",
                    K.court_path_name(F.col("court_name")).alias("court_path"),
                    K.index_name(F.col("court_name")).alias("index_name"))


def q_objects_found(spark, sf):
    k = _keyed(spark, sf).where(~F.col("skipped"))
    o = _objects(spark, sf).select(F.col("key").alias("s3_key"))
    return k.join(o, "s3_key", "left_semi").select("doc_id", "s3_key")


def q_keys_not_found(spark, sf):
    k = _keyed(spark, sf).where(~F.col("skipped"))
    o = _objects(spark, sf).select(F.col("key").alias("s3_key"))
    return k.join(o, "s3_key", "left_anti").select("doc_id", "s3_key")


HOT_KEY = "data/pdf/year=2000/court=hot/bench=hot/None"


def _hot_metadata(spark, sf):
    """The metadata with a third of all records in one run, without a link: all of them name one object."""
    hot = F.col("doc_id") % 3 == 0
    plain = SI.metadata(spark, sf)
    fixed = {"year": "2000", "court_code": "hot", "bench": "hot", "decision_date": "2000-01-01", "pdf_link": None}
    return plain.withColumns({c: F.when(hot, F.lit(v)).otherwise(F.col(c)) for c, v in fixed.items()})


def _hot_objects(spark, sf):
    one = SI.table(spark, sf, "benchmark").select(F.min(F.struct("item_id", "text")).alias("o")).select(
        F.lit(HOT_KEY).alias("key"), F.col("o.text").alias("text"), *[F.lit(None).cast("string").alias(c) for c in ("extract_error", "fetch_error", "general_error")])
    return _objects(spark, sf).unionByName(one)


def q_lookup_hot_key(spark, sf):
    """J1 where a third of all records name one object."""
    stage = indexing.lookup_and_chunk(_hot_metadata(spark, sf), _hot_objects(spark, sf))
    return stage.where(F.col("outcome") != indexing.SKIPPED).select("doc_id", "s3_key", "outcome", "token_count", "chunk_count")


def _stage2(spark, sf, meta=None):
    meta = meta if meta is not None else SI.metadata(spark, sf)
    return indexing.index(meta, _objects(spark, sf), embedder=hashing_embedder(SI.TEST_EMBED_DIM))


def q_vector_records(spark, sf):
    v = _stage2(spark, sf).vectors
    return v.select("index_name", "key", "s3_key", F.col("metadata.cnr").alias("cnr"),
                    F.col("metadata.title").alias("title"), F.col("metadata.year").alias("year"),
                    F.col("metadata.content").alias("content"),
                    F.size(F.filter("data", lambda x: x != 0)).cast("long").alias("nonzero"))


def q_vector_upsert(spark, sf):
    v = _stage2(spark, sf).vectors.select("index_name", "key", "s3_key", "upsert_date",
                                          F.col("metadata.content").alias("content"))
    latest = upsert.latest(v, ["index_name", "key"], ["upsert_date", "s3_key"])
    return latest.select("index_name", "key", "s3_key", "content")


def q_vectors_from_store(spark, sf):
    """The vectors of a second run, whose embedder answers nothing: every one of them comes from the first run's store."""
    meta, store = SI.metadata(spark, sf), _scratch(spark)
    path = _scratch(spark)
    indexing.lookup_and_chunk(meta, _objects(spark, sf)).write.parquet(path)
    stage = spark.read.parquet(path)
    indexing.derive(stage, list(meta.columns), hashing_embedder(SI.TEST_EMBED_DIM), store)
    v = indexing.derive(stage, list(meta.columns), lambda content: F.lit(None).cast("array<float>"), store).vectors
    return v.select("index_name", "key", "s3_key", F.col("metadata.cnr").alias("cnr"), F.col("metadata.title").alias("title"),
                    F.col("metadata.year").alias("year"), F.col("metadata.content").alias("content"),
                    F.size(F.filter("data", lambda x: x != 0)).cast("long").alias("nonzero"))


_ITEM_COLS = ["pk", "sk", "s3_key", "doc_id", "title", "court", "decision_date", "date_of_registration",
              "pdf_link", "priority", "year", "court_code", "bench"]


def q_metadata_items(spark, sf):
    return _stage2(spark, sf).items.select(*_ITEM_COLS)


def q_metadata_rejects(spark, sf):
    return _stage2(spark, sf).rejects.select(*_ITEM_COLS)


def q_metadata_upsert(spark, sf):
    it = _stage2(spark, sf).items.select(*_ITEM_COLS, indexing.upsert_date(F.col("decision_date")).alias("upsert_date"))
    return upsert.latest(it, ["pk", "sk"], ["upsert_date", "s3_key"]).select(*_ITEM_COLS)


def _stats(spark, sf, meta=None):
    """The stage table is written once; records and chunks both read it. The vector store refuses some chunks."""
    meta = meta if meta is not None else SI.metadata(spark, sf)
    stage = written(indexing.lookup_and_chunk(meta, _objects(spark, sf)), "stage")
    r = indexing.derive(stage, list(meta.columns), hashing_embedder(SI.TEST_EMBED_DIM))
    refused = F.when((F.length("s3_key") + F.col("chunk_id")) % 11 == 0, F.lit("slow down"))
    return stats.run_stats(r.records, r.chunks.withColumn("upload_error", refused))


_RUN = ["year", "court_code", "bench", "court_name"]


def q_run_counts(spark, sf):
    return _stats(spark, sf).select(*_RUN, "total_documents_attempted", "successful_documents",
                                    "failed_documents", "empty_text_documents", "keys_not_found")


def q_error_counts(spark, sf):
    return _stats(spark, sf).select(*_RUN, "pdf_extraction_errors", "embedding_generation_errors",
                                    "dynamodb_write_errors", "s3_upload_errors")


def q_success_rate(spark, sf):
    return _stats(spark, sf).select(*_RUN, F.round("success_rate_percent", 9).alias("success_rate_percent"))


def q_token_stats(spark, sf):
    return _stats(spark, sf).select(*_RUN, F.round("avg_tokens_per_document", 9).alias("avg_tokens_per_document"),
                                    "total_tokens", "min_tokens", "max_tokens")


def q_chunk_stats(spark, sf):
    return _stats(spark, sf).select(*_RUN, F.round("avg_chunks_per_document", 9).alias("avg_chunks_per_document"),
                                    "total_chunks")


RANKS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def q_count_distributions(spark, sf):
    """A3 + A8 merged over runs: quantiles of tokens a document and court, from the sketches in the statistics sink, each with
    the share of the court's documents below it and not above it; both within the sketch's rank error of the rank asked for."""
    from lexcurate.sinks.writers import write_stats

    meta = SI.metadata(spark, sf)
    stage = written(indexing.lookup_and_chunk(meta, _objects(spark, sf)), "stage")
    r = indexing.derive(stage, list(meta.columns), hashing_embedder(SI.TEST_EMBED_DIM))
    path = write_stats(stats.run_stats(r.records), _scratch(spark))
    sink = spark.read.schema("court_code string, token_sketch string, chunk_sketch string").json(path)
    q = stats.distribution(sink, ["court_code"], RANKS)
    counts = r.records.where(F.col("outcome") == indexing.SUCCESS).groupBy("court_code", "token_count").agg(F.count(F.lit(1)).alias("docs"))
    at = q.join(counts, "court_code").groupBy("court_code", "rank", "n").agg(  # a row a distinct count and rank, not a document
        (F.sum(F.when(F.col("token_count") < F.col("quantile"), F.col("docs")).otherwise(0)) / F.col("n")).alias("below"),
        (F.sum(F.when(F.col("token_count") <= F.col("quantile"), F.col("docs")).otherwise(0)) / F.col("n")).alias("up_to"))
    error = stats.RANK_ERROR + 1 / F.col("n")  # a rank falls between two documents
    return at.select("court_code", "rank", "n", ((F.col("below") <= F.col("rank") + error) & (F.col("up_to") >= F.col("rank") - error)).alias("within_error"))


def q_document_counts(spark, sf):
    """A8 rows: token and chunk count of every successful document."""
    r = _stage2(spark, sf).records
    return r.where(F.col("outcome") == indexing.SUCCESS).select(*_RUN, "s3_key", "token_count", "chunk_count")


def q_titles(spark, sf):
    return stats.titles(_stage2(spark, sf).records)


def q_titles_sink(spark, sf):
    """K5: the titles as they lie in the sink, by court path and run."""
    from lexcurate.sinks.writers import write_titles

    path = write_titles(stats.titles(_stage2(spark, sf).records), _scratch(spark))
    return spark.read.parquet(path).select("court_path", "court_code", "year", "bench", "s3_key", "title")


def q_run_times(spark, sf):
    """Identity and times of two runs, as their statistics record them."""
    from lexcurate.plans import jobs

    root, meta, objects = _scratch(spark), SI.metadata(spark, sf), written(_objects(spark, sf), "objects")  # a store that both runs read
    early = F.coalesce(F.col("year").try_cast("int") <= 1996, F.lit(False))
    for version, some in (("1", meta.where(early)), ("2", meta.where(~early))):
        out = jobs.run_indexing(spark, some, objects, root, version, embedder=hashing_embedder(SI.TEST_EMBED_DIM))
    runs = spark.read.schema("year string, court_code string, bench string, process_id string, processing_date string, start_time double, "
                             "end_time double, total_processing_time_seconds double").json(out.stats_path)
    took = F.col("end_time") - F.col("start_time")
    lasts = (took > 0) & (F.abs(took - F.col("total_processing_time_seconds")) < 1e-3)
    dated = F.abs(F.to_timestamp("processing_date").cast("double") - F.col("start_time")) < 86400 * 2
    per = runs.groupBy(F.coalesce(F.col("year").try_cast("int") <= 1996, F.lit(False)).alias("early")).agg(
        F.count_distinct("process_id").alias("ids"), F.count_distinct("start_time").alias("starts"), F.count(F.lit(1)).alias("runs"),
        F.bool_and(lasts).alias("end_after_start"), F.bool_and(dated).alias("dated"))
    return per


def q_failed_files(spark, sf):
    return stats.failed_files(_stage2(spark, sf).records)


def q_year_range_run(spark, sf):
    """M1: the years from 1994 to 1996 of every court and bench in one job."""
    meta = SI.metadata(spark, sf).where(F.col("year").try_cast("int").between(1994, 1996))
    st = _stats(spark, sf, meta)
    return st.select(*_RUN, "total_documents_attempted", "successful_documents", "total_chunks")


# --------------------------------------------------------------------------- logs

def _scratch(spark) -> str:
    from lexcurate.session import scratch_path

    return scratch_path(spark, "catalogue-" + uuid.uuid4().hex)


def q_log_roundtrip(spark, sf):
    """K2 -> S6 + P9: write the stage-1 log as JSON lines partitioned by
    year / court, read it back; the year is that of the folder."""
    from lexcurate.sinks.writers import write_log
    from lexcurate.sources.readers import read_logs

    out = _scratch(spark)
    write_log(_document_log(spark, sf), out)
    back = read_logs(spark, f"{out}/year=*/court=*/origin=*/*.json")
    return _read_back(back)


def _read_back(logs):
    return logs.select("key", "status", "word_ratio_before", F.col("lang_before.lang").alias("lang_before"),
                       "word_ratio_after", F.col("lang_after.lang").alias("lang_after"), "did_ocr", "doc_type", "log_year")


def _foreign_logs(spark, sf) -> str:
    """Log files as other writers leave them: pretty-printed records for 1995; else one record a line,
    every hundredth cut short, as by a killed writer."""
    from lexcurate.sinks.writers import log_json

    out = _scratch(spark)
    log = log_json(_document_log(spark, sf))
    record = F.to_json(F.struct(*[c for c in log.columns if c not in ("year", "court", "bench")]), {"ignoreNullFields": "false"})
    number = F.regexp_extract("key", r"/(\d+)\.[^/.]*$", 1).cast("long")
    line = F.when(F.col("year") == "1995", F.regexp_replace(record, ',"', ',\n    "')) \
        .when(number % 100 == 3, F.substring(record, 1, 60)).otherwise(record)
    log.select("year", line.alias("value")).repartition("year").write.partitionBy("year").text(out)
    return f"{out}/year=*/*.txt"


def q_log_read(spark, sf):
    """S6 over files with cut lines and pretty-printed records: every sound record, whatever lies beside it."""
    from lexcurate.sources.readers import read_logs

    return _read_back(read_logs(spark, _foreign_logs(spark, sf)))


def q_log_rejects(spark, sf):
    """What S6 refuses, line by line."""
    from lexcurate.sources.readers import log_rejects

    return log_rejects(spark, _foreign_logs(spark, sf)).select("line")


def q_log_backfill(spark, sf):
    """K7 + P9: log files of other writers, named by their year, brought into the log's layout; two folders hold files of one name."""
    from lexcurate.plans import jobs
    from lexcurate.sinks.writers import log_json
    from lexcurate.sources import files

    root, out = _scratch(spark), _scratch(spark)
    log = log_json(_document_log(spark, sf))
    record = F.to_json(F.struct(*[c for c in log.columns if c not in ("year", "court", "bench")]), {"ignoreNullFields": "false"})
    folder = F.concat(F.lit("part"), F.crc32("key") % 2)
    log.select(folder.alias("folder"), "year", record.alias("value")).repartition("folder", "year").write.partitionBy("folder", "year").text(root)
    for path in files.glob(spark, f"{root}/folder=*/year=*/part-*", files_only=True):  # a file a folder and year
        files.rename(spark, path, f"processing_log_{path.split('/year=')[1].split('/')[0]}.jsonl")
    for part in ("part0", "part1", "part0"):  # one of them twice: its records are replaced
        jobs.backfill_logs(spark, f"{root}/folder={part}/year=*/processing*", out)
    rows = spark.read.schema("key string, status string, word_ratio_before double, lang_before array<string>, did_ocr boolean, doc_type string, "
                             "year string, court string").json(f"{out}/logs")
    return rows.select("key", "status", "word_ratio_before", F.col("lang_before")[0].alias("lang_before"), "did_ocr", "doc_type", "year", "court")


def q_curated_copy(spark, sf):
    """E1 as a job: the curated store holds the repaired text of repaired documents."""
    from lexcurate.plans import jobs

    out = jobs.run_curation(spark, _stage1_docs(spark, sf), _scratch(spark), langid.GivenLanguage("lang"),
                            SI.repaired_text(spark, sf), min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED)
    return spark.read.parquet(out.curated_path).select("key", "year", "court", "bench", "text")


def q_uploads_refused(spark, sf):
    """T11 + K1 as a job whose uploads fail as they occur: the log names the failure, and the store lacks those documents."""
    from lexcurate.plans import jobs
    from lexcurate.sources.readers import read_logs

    refused = lambda doc: F.when(F.conv(F.substring(F.md5(doc["key"]), 1, 8), 16, 10).cast("long") % 7 < 3, F.concat(F.lit("denied "), doc["year"]))
    out = jobs.run_curation(spark, _stage1_docs(spark, sf), _scratch(spark), langid.GivenLanguage("lang"), SI.repaired_text(spark, sf),
                            min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED, uploader=refused)
    log = read_logs(spark, f"{out.log_path}/year=*/court=*/origin=*/*.json").select("key", "status", "doc_type")
    stored = spark.read.parquet(out.curated_path).select("key", F.lit(True).alias("stored"))
    return log.join(stored, "key", "left").select("key", "status", "doc_type", F.coalesce("stored", F.lit(False)).alias("stored"))


def q_curated_after_two_runs(spark, sf):
    """K1 as a job: two runs into one root, the second with half of the documents, some of them for the second time.
    Both runs' documents are there, and ``content`` names the run that wrote last."""
    from lexcurate.plans import jobs

    root, docs, repaired = _scratch(spark), _stage1_docs(spark, sf), SI.repaired_text(spark, sf)
    for content, some in (("first", docs.where("doc_id % 3 <> 0")), ("second", docs.where("doc_id % 2 = 0"))):
        out = jobs.run_curation(spark, some.withColumn("content", F.encode(F.lit(content), "UTF-8")), root, langid.GivenLanguage("lang"),
                                repaired, min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED)
    return spark.read.parquet(out.curated_path).select("key", "year", "court", "bench", "text", F.col("content").cast("string").alias("content"))


def _two_batches(spark, sf, rows, write):
    """The rows of two batches written one after the other: documents not divisible by 3, then the others."""
    rows, path = written(rows, "batches"), _scratch(spark)
    number = F.regexp_extract("s3_key", r"/(\d+)\.[^/.]*$", 1)
    later = F.coalesce(F.when(number != "", number).cast("long") % 3 == 0, F.lit(False))
    write(spark, rows.where(~later), path, "1")
    return upsert.read_table(spark, write(spark, rows.where(later), path, "2", "1"))


def q_items_after_two_batches(spark, sf):
    """K4 as a sink: a later batch replaces what an earlier one wrote, whatever its dates."""
    from lexcurate.sinks import writers

    items = _stage2(spark, sf).items.select(*_ITEM_COLS)
    return _two_batches(spark, sf, items, writers.write_items).select(*_ITEM_COLS)


def q_vectors_after_two_batches(spark, sf):
    """K3 as a sink."""
    from lexcurate.sinks import writers

    v = _two_batches(spark, sf, _stage2(spark, sf).vectors, writers.write_vectors)
    return v.select("index_name", "key", "s3_key", F.col("metadata.content").alias("content"))


def q_two_runs_one_root(spark, sf):
    """E2 as a job, for two sets of years (until 1996, and all others) one after the other into one root: each run keeps its statistics."""
    from lexcurate.plans import jobs

    root, meta, objects = _scratch(spark), SI.metadata(spark, sf), written(_objects(spark, sf), "objects")  # a store that both runs read
    embedder = hashing_embedder(SI.TEST_EMBED_DIM)
    early = F.coalesce(F.col("year").try_cast("int") <= 1996, F.lit(False))
    jobs.run_indexing(spark, meta.where(early), objects, root, "1", embedder=embedder)
    out = jobs.run_indexing(spark, meta.where(~early), objects, root, "2", current_version="1", embedder=embedder)
    runs = spark.read.json(out.stats_path)
    return runs.groupBy("year", "process_id").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("total_documents_attempted").alias("attempted"),
        F.sum("successful_documents").alias("successful"), F.sum("total_chunks").alias("chunks")).drop("process_id")


def _mixed_metadata(spark, sf) -> str:
    """Metadata partitions as different writers leave them: by year, ``decision_date`` is a date, a timestamp or
    a string, and some files lack ``priority``."""
    root, meta = _scratch(spark), SI.metadata(spark, sf)
    day = F.try_to_date("decision_date", "yyyy-M-d")
    noon = day.cast("timestamp") + F.make_dt_interval(hours=(F.col("doc_id") % 24).cast("int"))
    kind = F.coalesce(F.col("year").try_cast("int") % 4, F.lit(2))
    for k, rows in enumerate([meta.withColumn("decision_date", day), meta.withColumn("decision_date", noon), meta, meta.drop("priority")]):
        rows.where(kind == k).repartition("year", "court_code", "bench").write.mode("append").partitionBy("year", "court_code", "bench").parquet(root)
    return root


def q_metadata_mixed(spark, sf):
    """S3 over files that type a column differently, or lack one: one record, its key from the date itself."""
    from lexcurate.sources.readers import metadata_partitions

    meta = metadata_partitions(spark, _mixed_metadata(spark, sf), court_dir="court_code", file_glob="*.parquet")
    k = indexing.keyed_records(meta)
    return k.select("doc_id", "year", "court_code", "bench", "cnr", "decision_date", "date_of_registration", "priority", "year_val", "s3_key")


def q_years_with_broken_file(spark, sf):
    """M1 + M2 as a job: the first partition's file is cut in half; all others run, and the ledger names the one that failed."""
    from lexcurate.plans import jobs, ledger
    from lexcurate.sources.metadata import list_files, partition_glob

    root, out = _mixed_metadata(spark, sf), _scratch(spark)
    files = list_files(spark, partition_glob(root, year_range=(1900, 2100), court_dir="court_code"), "*.parquet")
    cut_short(spark, files[0])
    jobs.run_years(spark, root, _objects(spark, sf), out, "1", 1900, 2100, court_dir="court_code", file_glob="*.parquet",
                   embedder=hashing_embedder(SI.TEST_EMBED_DIM))
    runs = spark.read.schema("year string, court_code string, bench string, total_documents_attempted long, successful_documents long, "
                             "total_chunks long").json(f"{out}/stats")
    states = ledger.states(spark, out).select(*ledger.KEYS, "state", "records")
    return states.join(runs, ledger.KEYS, "left").select(*ledger.KEYS, "state", "records", "total_documents_attempted", "successful_documents",
                                                         F.coalesce("total_chunks", F.lit(0)).alias("total_chunks"))


def cut_short(spark, path: str) -> None:
    """Leaves the first half of a file, as a writer does that was stopped."""
    content = spark.read.format("binaryFile").load(path).first().content
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(content[:len(content) // 2])
    out.close()


def q_document_log_stream(spark, sf):
    """Stage 1 through Structured Streaming: the stage-1 documents land as
    parquet files, an ``availableNow`` file stream drains them one file per
    micro-batch, and the appended log is read back. Equals the batch log."""
    from lexcurate.streaming.incremental import curation_stream

    base = _scratch(spark)
    docs = _stage1_docs(spark, sf).select("key", "year", "court", "bench", "text", "lang")
    docs.repartition(4, "key").write.parquet(f"{base}/landing")
    q = curation_stream(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint",
                        langid.GivenLanguage("lang"), SI.repaired_text(spark, sf), max_files_per_trigger=1,
                        min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED)
    q.awaitTermination()
    return _flat_log(spark.read.parquet(f"{base}/out/log"))


QUERIES = {
    "scan_partition": q_scan_partition,
    "store_scan": q_store_scan,
    "failure_statuses": q_failure_statuses,
    "log_backfill": q_log_backfill,
    "titles_sink": q_titles_sink,
    "run_times": q_run_times,
    "doc_type_latin": q_doc_type_latin,
    "doc_type_multi": q_doc_type_multi,
    "garble_gate": q_garble_gate,
    "repair_status": q_repair_status,
    "document_log": q_document_log,
    "document_log_multi": q_document_log_multi,
    "document_log_models": q_document_log_models,
    "document_log_stream": q_document_log_stream,
    "curated": q_curated,
    "word_ratio": q_word_ratio,
    "token_count": q_token_count,
    "sentences": q_sentences,
    "sentence_model": q_sentence_model,
    "sentences_trained": q_sentences_trained,
    "chunks": q_chunks,
    "chunk_embedding": q_chunk_embedding,
    "pages_newline": q_pages_newline,
    "pages_concat": q_pages_concat,
    "word_freq": q_word_freq,
    "frequent_words": q_frequent_words,
    "word_ratio_freq": q_word_ratio_freq,
    "lang_profiles": q_lang_profiles,
    "detect_language": q_detect_language,
    "object_key": q_object_key,
    "object_key_skip": q_object_key_skip,
    "court_index_name": q_court_index_name,
    "objects_found": q_objects_found,
    "keys_not_found": q_keys_not_found,
    "vector_records": q_vector_records,
    "vector_upsert": q_vector_upsert,
    "metadata_items": q_metadata_items,
    "metadata_rejects": q_metadata_rejects,
    "metadata_upsert": q_metadata_upsert,
    "run_counts": q_run_counts,
    "error_counts": q_error_counts,
    "success_rate": q_success_rate,
    "token_stats": q_token_stats,
    "chunk_stats": q_chunk_stats,
    "document_counts": q_document_counts,
    "count_distributions": q_count_distributions,
    "titles": q_titles,
    "failed_files": q_failed_files,
    "year_range_run": q_year_range_run,
    "log_roundtrip": q_log_roundtrip,
    "log_read": q_log_read,
    "log_rejects": q_log_rejects,
    "curated_copy": q_curated_copy,
    "items_after_two_batches": q_items_after_two_batches,
    "vectors_after_two_batches": q_vectors_after_two_batches,
    "two_runs_one_root": q_two_runs_one_root,
    "vectors_from_store": q_vectors_from_store,
    "lookup_hot_key": q_lookup_hot_key,
    "uploads_refused": q_uploads_refused,
    "curated_after_two_runs": q_curated_after_two_runs,
    "metadata_mixed": q_metadata_mixed,
    "years_with_broken_file": q_years_with_broken_file,
}
