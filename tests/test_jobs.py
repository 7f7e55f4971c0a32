from pyspark.sql import functions as F

from lexcurate.operators import langid, upsert
from lexcurate.operators.embedding import hashing_embedder
from lexcurate.plans import jobs, standins as SI
from lexcurate.plans.catalogue import _objects
from tests.conftest import SF_SMALL


def test_curation_job(spark, scratch):
    docs = SI.stage1_objects(spark, SF_SMALL).where(F.lower("key").endswith(".pdf"))
    out = jobs.run_curation(spark, docs, scratch, langid.GivenLanguage("lang"), SI.repaired_text(spark, SF_SMALL),
                            min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED)
    logs = spark.read.json(out.log_path)
    assert logs.count() == docs.count()
    assert set(logs.columns) >= {"key", "status", "lang_before", "did_ocr", "doc_type", "year", "court"}
    cur = spark.read.parquet(out.curated_path)
    judged = logs.where((F.col("doc_type") == "judgment") & F.col("status").isin("ok_no_ocr", "ok_after_ocr"))
    assert sorted(r.key for r in cur.collect()) == sorted(r.key for r in judged.collect())
    texts = {r.key: r.text for r in SI.repaired_text(spark, SF_SMALL).collect()}
    own = {r.key: r.text for r in docs.collect()}
    did = {r.key: r.did_ocr for r in logs.collect()}
    assert all(r.text == (texts if did[r.key] else own)[r.key] for r in cur.collect())
    # rerun: same partitions rewritten, nothing duplicated
    jobs.run_curation(spark, docs, scratch, langid.GivenLanguage("lang"), SI.repaired_text(spark, SF_SMALL),
                      min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED)
    assert spark.read.json(out.log_path).count() == docs.count()


def test_indexing_job_and_upsert_idempotent(spark, scratch):
    meta = SI.metadata(spark, SF_SMALL)
    objs = _objects(spark, SF_SMALL)
    emb = hashing_embedder(SI.TEST_EMBED_DIM)
    o1 = jobs.run_indexing(spark, meta, objs, scratch, "1", embedder=emb)
    o2 = jobs.run_indexing(spark, meta, objs, scratch, "2", current_version="1", embedder=emb)
    v1 = sorted((r.index_name, r.key, r.s3_key) for r in upsert.read_table(spark, o1.vectors_path).collect())
    v2 = sorted((r.index_name, r.key, r.s3_key) for r in upsert.read_table(spark, o2.vectors_path).collect())
    assert v1 == v2 and len(v1) > 0
    assert len({(a, b) for a, b, _ in v1}) == len(v1)  # one row per (index, key)
    st = spark.read.json(o2.stats_path)
    tot = st.agg(F.sum("total_documents_attempted"), F.sum("successful_documents"), F.sum("failed_documents"),
                 F.sum("keys_not_found")).first()
    assert tot[0] == tot[1] + tot[2] + tot[3]
    assert {"process_id", "start_time", "total_processing_time_seconds"} <= set(st.columns)
    records = spark.read.parquet(o2.stage_path)
    assert records.count() == meta.count()  # every record has one outcome row (skipped included)


def test_backfill_logs(spark, scratch):
    import json
    import os
    rec = {"key": "data/pdf/year=1995/court=28_2/bench=aphc/x.pdf", "status": "ok_no_ocr", "word_ratio_before": 0.9,
           "lang_before": ["en", 0.99], "word_ratio_after": None, "lang_after": None, "did_ocr": False,
           "doc_type": "order"}
    os.makedirs(f"{scratch}/in", exist_ok=True)
    with open(f"{scratch}/in/processing_log_1995.jsonl", "w") as f:
        f.write(json.dumps(rec) + "\n")
    with open(f"{scratch}/in/processing_2006.log", "w") as f:
        f.write("not a log record\n")
    path = jobs.backfill_logs(spark, f"{scratch}/in/processing*", f"{scratch}/out")
    rows = spark.read.json(path).collect()
    assert [(r.key, str(r.year), r.court) for r in rows] == [(rec["key"], "1995", "28_2")]
    # another file of the same year and court: both stay, also when one is repeated
    with open(f"{scratch}/in/more_log_1995.jsonl", "w") as f:
        f.write(json.dumps({**rec, "key": rec["key"] + "2"}) + "\n")
    for name in ("more_log_1995", "more_log_1995", "processing_log_1995"):
        jobs.backfill_logs(spark, f"{scratch}/in/{name}.jsonl", f"{scratch}/out")
    assert sorted(r.key for r in spark.read.json(path).collect()) == [rec["key"], rec["key"] + "2"]


def test_fetch_and_upload_errors(spark):
    rows = [("a", "JUDGMENT the reasons given here", None, None), ("b", "JUDGMENT the reasons given here", None, "denied"),
            ("c", "ORDER adjourned to monday", None, "denied"), ("d", None, "gone", "denied")]
    docs = spark.createDataFrame(rows, "key string, text string, fetch string, upload string").withColumn("lang", F.lit("en"))
    twice = spark.createDataFrame([("a", "x", "en"), ("a", "y", "en")], "key string, text string, lang string")
    log = jobs.quality.assess(docs, langid.GivenLanguage("lang"), twice, fetch_error_col="fetch", upload_error_col="upload", min_ratio=0.1)
    assert {r.key: r.status for r in log.collect()} == {
        "a": "ok_no_ocr", "b": "upload_failed: denied", "c": "ok_no_ocr", "d": "download_failed: gone"}
    assert log.count() == 4


def test_one_record_has_one_outcome(spark):
    from lexcurate.plans import indexing

    meta = SI.metadata(spark, SF_SMALL)
    objects = _objects(spark, SF_SMALL)
    stage = indexing.lookup_and_chunk(meta, objects.union(objects))
    assert stage.count() == meta.count()
    assert {r.outcome for r in stage.select("outcome").distinct().collect()} >= {
        "success", "key_not_found", "error_with_getting_file", "pdf_extraction_error", "empty_text", "general_error"}
    assert "raw_html" not in stage.columns


def test_curation_stream(spark, scratch):
    from lexcurate.streaming.incremental import curation_stream

    docs = SI.stage1_objects(spark, SF_SMALL).select("key", "year", "court", "bench", "text", "lang")
    docs.repartition(3).write.parquet(f"{scratch}/landing")
    q = curation_stream(spark, f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt",
                        langid.GivenLanguage("lang"), SI.repaired_text(spark, SF_SMALL),
                        max_files_per_trigger=1, min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED)
    q.awaitTermination(300)
    log = spark.read.parquet(f"{scratch}/out/log")
    assert log.count() == docs.count()
    kept = jobs.quality.curated(log)
    assert sorted(r.key for r in spark.read.parquet(f"{scratch}/out/curated").collect()) == sorted(r.key for r in kept.collect())


def test_a_file_of_the_stream_is_dealt_over_the_cores(spark, scratch):
    from lexcurate.functions.partitioning import spread_by_key

    docs = SI.stage1_objects(spark, SF_SMALL).select("key", "text")
    docs.repartition(4, "key").where(F.spark_partition_id() == 1).coalesce(1).write.parquet(f"{scratch}/landing")
    one, cores = spark.read.parquet(f"{scratch}/landing"), spark.sparkContext.defaultParallelism
    dealt = [r["count"] for r in spread_by_key(one, "key", 1).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(dealt) == one.count() and max(dealt) <= one.count() * min(1, 4 / cores)
    assert spread_by_key(one, "key", cores) is one


def test_year_range_job_over_partitioned_metadata(spark, scratch):
    from lexcurate.sources.readers import metadata_partitions

    meta = SI.metadata(spark, SF_SMALL)
    meta.write.partitionBy("year", "court_code", "bench").parquet(f"{scratch}/metadata")
    one = metadata_partitions(spark, f"{scratch}/metadata", year="1996", court_dir="court_code", file_glob=None)
    assert {r.year for r in one.select("year").distinct().collect()} == {"1996"}
    assert one.count() == meta.where(F.col("year") == "1996").count()
    assert "court" in one.columns and one.where(~F.col("court").startswith("High Court")).count() == 0
    out = jobs.run_years(spark, f"{scratch}/metadata", _objects(spark, SF_SMALL), f"{scratch}/out", "1", 1995, 1997,
                         court_dir="court_code", file_glob=None, embedder=hashing_embedder(SI.TEST_EMBED_DIM))
    years = {str(r.year) for r in spark.read.json(out.stats_path).select("year").distinct().collect()}
    assert years == {"1995", "1996", "1997"}
    expect = meta.where(F.col("year").between("1995", "1997")).count()
    assert spark.read.parquet(out.stage_path).count() == expect


def test_stage1_from_pdf_listing_and_pages(spark, scratch):
    import os

    from lexcurate.plans.jobs import stage1_documents

    root = f"{scratch}/store"
    files = {"data/pdf/year=1995/court=28_2/bench=aphc/a.pdf": b"%PDF a",
             "data/pdf/year=1995/court=28_2/bench=aphc/b.PDF": b"%PDF b",
             "data/pdf/year=1995/court=28_2/bench=aphc/c.pdf": b"",
             "data/pdf/year=1995/court=16~20/bench=x/d.pdf": b"%PDF d"}
    for rel, data in files.items():
        os.makedirs(os.path.dirname(f"{root}/{rel}"), exist_ok=True)
        with open(f"{root}/{rel}", "wb") as f:
            f.write(data)
    pages = spark.createDataFrame([
        ("data/pdf/year=1995/court=28_2/bench=aphc/a.pdf", 1, "REASONS given"),
        ("data/pdf/year=1995/court=28_2/bench=aphc/a.pdf", 0, "JUDGMENT"),
        ("data/pdf/year=1995/court=16~20/bench=x/d.pdf", 0, "ORDER")], "doc_key string, page_no int, text string")
    docs = stage1_documents(spark, f"{root}/data/pdf", pages, year="1995", court="28_2")
    got = {r.key.rsplit("/", 1)[-1]: r.text for r in docs.collect()}
    # c.pdf has zero bytes: Spark's file sources do not list it
    assert got == {"a.pdf": "JUDGMENT\nREASONS given", "b.PDF": ""}
    log = {r.key.rsplit("/", 1)[-1]: r for r in
           jobs.quality.assess(docs, langid.GivenLanguage("bench"), None, allowed_langs="aphc").collect()}
    assert log["a.pdf"].doc_type == "judgment" and log["a.pdf"].status == "ok_no_ocr"
    assert log["b.PDF"].status == "ocr_failed" and log["b.PDF"].doc_type == "order"


def test_curation_job_with_trained_models(spark, scratch):
    from lexcurate.operators import frequency

    docs = SI.stage1_objects(spark, SF_SMALL).where(F.lower("key").endswith(".pdf"))
    det = langid.NaiveBayesDetector(langid.train_profiles(SI.table(spark, SF_SMALL, "documents")))
    freq = frequency.frequency_list(SI.table(spark, SF_SMALL, "benchmark"))
    out = jobs.run_curation(spark, docs, scratch, det, SI.repaired_text(spark, SF_SMALL), freq=freq,
                            min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED, lexicon="multi")
    logs = spark.read.json(out.log_path)
    assert logs.count() == docs.count()
    assert logs.where(F.col("lang_before").isNull()).count() == 0


def test_repaired_document_is_stored_repaired(spark, scratch):
    docs = spark.createDataFrame([("a", "JUDGMENT xx zz qq ww vv", "fr"), ("b", "JUDGMENT the reasons are given here", "en")],
                                 "key string, text string, lang string").selectExpr("*", "'1995' year", "'c' court", "'b' bench", "encode(text, 'UTF-8') content")
    rep = spark.createDataFrame([("a", "JUDGMENT the repaired reasons", "en")], "key string, text string, lang string").withColumn(
        "content", F.encode("text", "UTF-8"))
    out = jobs.run_curation(spark, docs, scratch, langid.GivenLanguage("lang"), rep, min_ratio=0.6, allowed_langs="en")
    rows = {r.key: (r.text, bytes(r.content).decode()) for r in spark.read.parquet(out.curated_path).collect()}
    assert rows == {"a": ("JUDGMENT the repaired reasons",) * 2, "b": ("JUDGMENT the reasons are given here",) * 2}


def test_each_curated_document_is_uploaded_once(spark, scratch):
    import pandas as pd

    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def upload(doc: pd.DataFrame) -> pd.Series:
        calls.add(len(doc))
        return doc["key"].map(lambda k: "slow down" if k == "b" else None)

    docs = spark.createDataFrame([(k, t, "en") for k, t in (("a", "JUDGMENT the reasons are given"), ("b", "JUDGMENT the reasons are given"), ("c", "ORDER adjourned"))],
                                 "key string, text string, lang string").selectExpr("*", "'1995' year", "'c' court", "'b' bench")
    out = jobs.run_curation(spark, docs, scratch, langid.GivenLanguage("lang"), min_ratio=0.1, allowed_langs="en", uploader=upload.asNondeterministic())
    assert {r.key: r.status for r in spark.read.json(out.log_path).collect()} == {"a": "ok_no_ocr", "b": "upload_failed: slow down", "c": "ok_no_ocr"}
    assert [r.key for r in spark.read.parquet(out.curated_path).collect()] == ["a"] and calls.value == 2


def test_folders_of_a_sink_are_dealt_over_tasks(spark, scratch):
    from lexcurate.sinks import writers

    rows = spark.range(300).select((F.col("id") % 60).cast("string").alias("year"), F.lit("c").alias("court_code"), F.lit("b").alias("bench"), "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    path = writers.write_partitioned(rows, f"{scratch}/sink", ["year", "court_code", "bench"])
    files = spark.read.parquet(path).select(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).alias("task"), F.input_file_name().alias("file")).distinct().collect()
    assert len(files) == 60 and len({r.task for r in files}) > 1  # one file a folder, by more than one task
    assert spark.read.parquet(path).count() == 300 and spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize") == before
