import json
import os


from lexcurate.sources.readers import assemble_pages, log_rejects, metadata_partitions, pdf_objects, read_logs


def test_binary_listing_keeps_partitions_and_filters(spark, scratch):
    for rel in ["year=2001/court=16~20/bench=b1/a.pdf", "year=2001/court=16~20/bench=b1/b.PDF",
                "year=2001/court=16~20/bench=b1/c.txt", "year=2001/court=36_29/bench=b2/d.pdf",
                "year=None/court=36_29/bench=b2/e.pdf"]:
        p = os.path.join(scratch, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(b"%PDF-1.4 " + rel.encode())
    df = pdf_objects(spark, scratch, year="2001", court="16~20")
    names = sorted(r.path.rsplit("/", 1)[-1] for r in df.collect())
    assert names == ["a.pdf", "b.PDF"]
    allc = pdf_objects(spark, scratch, with_content=False)
    assert dict(allc.schema.fields and [(f.name, f.dataType.simpleString()) for f in allc.schema.fields])["year"] \
        == "string"
    assert sorted(r.year for r in allc.collect()) == ["2001", "2001", "2001", "None"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionFilters" in plan.lower()


def test_year_range_passes_over_partitions_without_a_year(spark, scratch):
    for rel in ["year=2001/court=c/bench=b/a.pdf", "year=1990/court=c/bench=b/b.pdf", "year=None/court=c/bench=b/e.pdf"]:
        os.makedirs(os.path.dirname(f"{scratch}/{rel}"), exist_ok=True)
        with open(f"{scratch}/{rel}", "wb") as f:
            f.write(b"%PDF")
    assert [r.year for r in pdf_objects(spark, scratch, year_range=(2000, 2005), with_content=False).collect()] == ["2001"]


def test_large_object_is_an_error_of_its_own(spark, scratch):
    os.makedirs(f"{scratch}/year=2001/court=c/bench=b")
    for name, n in (("a.pdf", 10), ("b.pdf", 2000)):
        with open(f"{scratch}/year=2001/court=c/bench=b/{name}", "wb") as f:
            f.write(b"x" * n)
    rows = {r.path[-5:]: r for r in pdf_objects(spark, scratch, max_bytes=1000).collect()}
    assert bytes(rows["a.pdf"].content) == b"x" * 10 and rows["a.pdf"].fetch_error is None
    assert rows["b.pdf"].content is None and "2000" in rows["b.pdf"].fetch_error


def test_metadata_columns_and_files(spark, scratch):
    spark.createDataFrame([("1", "x")], "cnr string, court string").coalesce(1).write.parquet(f"{scratch}/a")
    spark.createDataFrame([("2", "y", "J")], "cnr string, court string, judge string").coalesce(1).write.parquet(f"{scratch}/b")
    for year, part in (("2001", "a"), ("2002", "b")):
        folder = f"{scratch}/m/year={year}/court=c/bench=b"
        os.makedirs(folder)
        source = [n for n in os.listdir(f"{scratch}/{part}") if n.endswith(".parquet")][0]
        for name in ("metadata.parquet", "x-metadata.parquet.bak.parquet"):
            with open(f"{scratch}/{part}/{source}", "rb") as f, open(f"{folder}/{name}", "wb") as g:
                g.write(f.read())
    rows = sorted((r.cnr, r.judge, r.year) for r in metadata_partitions(spark, f"{scratch}/m").collect())
    assert rows == [("1", None, "2001"), ("2", "J", "2002")]


def test_one_cut_line_loses_one_record(spark, scratch):
    record = {"key": "k", "status": "ok_no_ocr", "doc_type": "a {brace} and \"quote\"", "did_ocr": False}
    lines = [json.dumps(record | {"key": f"k{i}"}) for i in range(1000)]
    with open(f"{scratch}/processing_log_2001.jsonl", "w") as f:
        f.write("\n".join(lines) + "\n" + lines[0][:30])
    with open(f"{scratch}/processing_log_2002.jsonl", "w") as f:
        f.write("".join(json.dumps(record | {"key": f"p{i}"}, indent=2) + "\n" for i in range(3)) + "{\"key\": \"cut\",\n")
    got = read_logs(spark, f"{scratch}/processing*").collect()
    assert len(got) == 1003 and {r.log_year for r in got if r.key[0] == "p"} == {"2002"}
    assert {r.doc_type for r in got} == {record["doc_type"]}
    assert [r.line for r in log_rejects(spark, f"{scratch}/processing_log_2001*").collect()] == [lines[0][:30]]


def test_pages_both_variants(spark):
    pages = spark.createDataFrame([(1, 2, "b"), (1, 0, "a"), (1, 1, None), (1, 3, ""), (2, 0, None)],
                                  "doc_key long, page_no int, text string")
    nl = {r.doc_key: r.text for r in assemble_pages(pages, sep="\n", drop_empty=True).collect()}
    cc = {r.doc_key: r.text for r in assemble_pages(pages, sep="", drop_empty=False).collect()}
    assert nl == {1: "a\nb", 2: ""}
    assert cc == {1: "ab", 2: ""}


def test_logs_both_shapes(spark, scratch):
    rec = {"key": "data/pdf/year=1995/court=28_2/bench=aphc/x.pdf", "status": "ok_no_ocr",
           "word_ratio_before": 0.881578947368421, "lang_before": ["en", 0.9999958767899285],
           "word_ratio_after": None, "lang_after": None, "did_ocr": False, "doc_type": "order"}
    os.makedirs(f"{scratch}/logs", exist_ok=True)
    with open(f"{scratch}/logs/processing_log_1995.jsonl", "w") as f:
        f.write(json.dumps(rec, indent=4))
    with open(f"{scratch}/logs/processing_log_2006.jsonl", "w") as f:
        for i in range(3):
            f.write(json.dumps({**rec, "key": f"k{i}"}) + "\n")
    df = read_logs(spark, f"{scratch}/logs/processing*")
    rows = df.collect()
    assert len(rows) == 4
    assert sorted(r.log_year for r in rows) == ["1995", "2006", "2006", "2006"]
    one = [r for r in rows if r.log_year == "1995"][0]
    assert one.lang_before.lang == "en" and abs(one.lang_before.prob - 0.9999958767899285) < 1e-15


def test_pretty_printed_file_is_read_in_splits(spark, scratch):
    """A file of many splits, with strings that hold braces and quotes, records that share lines, a cut one and stray lines."""
    record = lambda i: {"key": f"k{i}", "status": 'a "quoted" {brace} }', "lang_before": ["en", 0.5], "doc_type": "order"}
    body = ["stray before\n"]
    for i in range(3000):
        text = json.dumps(record(i), indent=4)
        body.append(text[:40] + "\n" if i == 1500 else text + ("," if i % 7 == 0 else "") + ("" if i % 5 == 0 else "\n"))
        if i == 2000:
            body.append("\nnot a record\n")
    os.makedirs(f"{scratch}/logs", exist_ok=True)
    with open(f"{scratch}/logs/processing_log_1995.jsonl", "w") as f:
        f.write("".join(body))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(f"{scratch}/logs").rdd.getNumPartitions() > 10
        got = read_logs(spark, f"{scratch}/logs/*").collect()
        assert sorted(r.key for r in got) == sorted(f"k{i}" for i in range(3000) if i != 1500)
        assert {(r.status, r.lang_before.prob, r.log_year) for r in got} == {('a "quoted" {brace} }', 0.5, "1995")}
        rejects = [r.line for r in log_rejects(spark, f"{scratch}/logs/*").collect()]
        assert sorted(x.strip() for x in rejects if "{" not in x) == ["not a record", "stray before"]
        assert [x for x in rejects if "{" in x] and len(rejects) == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
