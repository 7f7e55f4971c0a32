from pyspark.sql import functions as F

from lexcurate.operators import stats
from lexcurate.operators.embedding import hashing_embedder
from lexcurate.plans import indexing

META_SCHEMA = ("year string, court_code string, bench string, cnr string, title string, court string, "
               "decision_date string, pdf_link string")


def run(spark, meta_rows, objects_rows, schema=META_SCHEMA):
    meta = spark.createDataFrame(meta_rows, schema)
    objs = spark.createDataFrame(objects_rows, "key string, text string, extract_error string")
    res = indexing.index(meta, objs, embedder=hashing_embedder(16))
    return res, stats.run_stats(res.records, res.chunks)


def test_every_key_missing_gives_null_success_rate(spark):
    rows = [("2001", "c1", "b1", f"C{i}", "t", "High Court", "2001-02-03", f"x/{i}.pdf") for i in range(3)]
    _, st = run(spark, rows, [("nothing", "text", None)])
    r = st.first()
    assert (r.total_documents_attempted, r.keys_not_found, r.successful_documents) == (3, 3, 0)
    assert r.success_rate_percent is None and r.avg_tokens_per_document is None


def test_titles_keep_nulls_and_counts_add_up(spark):
    key = "data/pdf/year=2001/court=c1/bench=b1/{}.pdf"
    rows = [("2001", "c1", "b1", "C1", None, "High Court", "2001-02-03", "x/a.pdf"),
            ("2001", "c1", "b1", "C2", "T2", "High Court", "2001-02-03", "x/b.pdf"),
            ("2001", "c1", "b1", "C3", "T3", "High Court", "2001-02-03", "x/c.pdf"),
            ("2001", "c1", "b1", None, "T4", "High Court", "2001-02-03", "x/d.pdf"),
            ("2001", "c1", "b1", "C5", "T5", "High Court", "2001-02-03", "x/")]      # skipped, uncounted
    objs = [(key.format("a"), "One. Two.", None), (key.format("b"), "   ", None),
            (key.format("c"), "x", "broken xref"), (key.format("d"), "Four.", None)]
    res, st = run(spark, rows, objs)
    titles = sorted((r.title is None, r.title or "") for r in stats.titles(res.records).collect())
    assert titles == [(False, "T4"), (True, "")]
    failed = {r.error: r.error_message for r in stats.failed_files(res.records).collect()}
    assert failed == {"empty_text": "No extractable text found in PDF", "pdf_extraction_error": "broken xref"}
    r = st.first()
    assert (r.total_documents_attempted, r.successful_documents, r.failed_documents, r.keys_not_found) == (4, 2, 2, 0)
    assert r.dynamodb_write_errors == 1 and r.success_rate_percent == 50.0
    assert [x.pk for x in res.items.collect()] == ["C1"] and [x.pk for x in res.rejects.collect()] == [None]


def test_missing_title_and_court_columns(spark):
    schema = "year string, court_code string, bench string, cnr string, decision_date string, pdf_link string"
    rows = [("2001", "c1", "b1", "C1", "2001-02-03", "x/a.pdf")]
    objs = [("data/pdf/year=2001/court=c1/bench=b1/a.pdf", "Some text here.", None)]
    res, st = run(spark, rows, objs, schema)
    assert [r.title for r in stats.titles(res.records).collect()] == ["a.pdf"]
    assert st.first().court_name == "unknown-court"
    assert {r.index_name for r in res.vectors.collect()} == {"unknown-court"}


def test_sketches_merge_over_runs_within_the_rank_error(spark, scratch):
    """A third of all documents in one run; quantiles of all runs together, from the records read back."""
    import numpy as np
    from pyspark.sql import functions as F

    from lexcurate.operators import stats
    from lexcurate.sinks.writers import write_stats

    n = 60_000
    rows = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("1999")).otherwise((F.col("id") % 9).cast("string")).alias("year"), F.lit("c").alias("court_code"),
        F.lit("b").alias("bench"), F.lit("X").alias("court_name"), F.when(F.col("id") % 100 == 5, F.lit("empty_text")).otherwise(F.lit("success")).alias("outcome"),
        F.lit(True).alias("has_cnr"), (F.col("id") * F.col("id") % 9973).alias("token_count"), F.lit(1).cast("long").alias("chunk_count"))
    none = rows.limit(3).withColumn("year", F.lit("none")).withColumn("outcome", F.lit("key_not_found"))
    path = write_stats(stats.run_stats(rows.unionByName(none)), scratch)
    back = spark.read.json(path)
    counts = np.sort([r[0] for r in rows.where("outcome = 'success'").select("token_count").collect()])
    got = stats.distribution(back, ["court_code"], [0.01, 0.5, 0.99]).collect()
    assert len(got) == 3 and all(r.n == len(counts) for r in got)
    for r in got:
        assert np.searchsorted(counts, r.quantile, "left") / len(counts) - stats.RANK_ERROR <= r.rank <= \
            np.searchsorted(counts, r.quantile, "right") / len(counts) + stats.RANK_ERROR
    assert stats.distribution(back.where("year = 'none'"), ["year"], [0.5]).collect() == []
    assert max(len(r.token_sketch) for r in back.where("token_sketch IS NOT NULL").collect()) < 20_000
