"""S3 and M2: files that differ in schema, broken files, the run ledger."""
import os

import pytest
from pyspark.sql import functions as F

from lexcurate.operators.embedding import hashing_embedder
from lexcurate.plans import indexing, jobs, ledger
from lexcurate.plans.catalogue import cut_short
from lexcurate.sources import metadata as M
from lexcurate.sources.readers import metadata_partitions


def put(spark, scratch, year, rows, schema, bench="b", name="metadata.parquet"):
    """One metadata file of a partition."""
    folder = f"{scratch}/m/year={year}/court=c/bench={bench}"
    os.makedirs(folder, exist_ok=True)
    spark.createDataFrame(rows, schema).selectExpr("*").coalesce(1).write.mode("overwrite").parquet(f"{scratch}/one")
    part = [n for n in os.listdir(f"{scratch}/one") if n.endswith(".parquet")][0]
    with open(f"{scratch}/one/{part}", "rb") as f, open(f"{folder}/{name}", "wb") as g:
        g.write(f.read())
    if os.path.exists(f"{folder}/.{name}.crc"):  # the checksum of a file written through Spark before
        os.remove(f"{folder}/.{name}.crc")
    return f"{folder}/{name}"


def store(spark, scratch, years=range(2000, 2006)):
    """A partition a year: decision_date as string, date or timestamp; ``judges`` as number or string or not at all."""
    import datetime as dt

    for y in years:
        value, kind = [(f"{y}-3-4", "string"), (dt.date(y, 3, 4), "date"), (dt.datetime(y, 3, 4, 5, 6, 7), "timestamp")][y % 3]
        judges = [", judges int", ", judges string", ""][y % 3 - 1]
        put(spark, scratch, y, [(f"C{y}", "A court", f"T{y}", value, f"x/{y}.pdf", "<p/>", *([[3, "three"][y % 3 - 1]] if judges else []))],
            f"cnr string, court string, title string, decision_date {kind}, pdf_link string, raw_html string{judges}")
    return f"{scratch}/m"


def objects(spark, years=range(2000, 2006)):
    return spark.createDataFrame([(f"data/pdf/year={y}/court=c/bench=b/{y}.pdf", f"The text of {y}. It ends.", None) for y in years],
                                 "key string, text string, extract_error string")


def run(spark, scratch, **kw):
    return jobs.run_years(spark, f"{scratch}/m", objects(spark), f"{scratch}/out", "1", 2000, 2005, embedder=hashing_embedder(8), **kw)


def states(spark, scratch):
    return {r.year: (r.state, r.records, r.error) for r in ledger.states(spark, f"{scratch}/out").collect()}


def test_types_that_differ_become_one_record(spark, scratch):
    df = metadata_partitions(spark, store(spark, scratch))
    rows = {r.year: r for r in indexing.keyed_records(df).collect()}
    form = ["{}-3-4", "{}-03-04", "{}-03-04T05:06:07"]
    assert {y: r.decision_date for y, r in rows.items()} == {str(y): form[y % 3].format(y) for y in range(2000, 2006)}
    assert all(r.s3_key == f"data/pdf/year={y}/court=c/bench=b/{y}.pdf" and r.court == "A court" for y, r in rows.items())
    assert {r.judges for r in rows.values()} == {"3", "three", None}


def test_types_that_agree_are_kept(spark, scratch):
    df = metadata_partitions(spark, store(spark, scratch, [2002, 2005]))  # both of one writer
    assert dict(df.dtypes)["decision_date"] == "date" and dict(df.dtypes)["judges"] == "int" and M.DECISION_YEAR not in df.columns and "raw_html" in df.columns


def test_few_scans_and_few_inferences(spark, scratch):
    store(spark, scratch)
    files = M.list_files(spark, M.partition_glob(f"{scratch}/m"), "*metadata.parquet")
    groups, broken = M.schemas(spark, files)
    assert not broken and len(M.scans(groups)) == 3  # one a way of typing, not one a file


def test_bad_files_fail_their_partitions_alone(spark, scratch):
    store(spark, scratch)
    cut_short(spark, f"{scratch}/m/year=2001/court=c/bench=b/metadata.parquet")
    open(f"{scratch}/m/year=2002/court=c/bench=b/metadata.parquet", "wb").close()
    many = [(f"C{i}", "A court", f"T{i}" * 50, "2003-3-4", f"x/{i}.pdf") for i in range(5000)]
    path = put(spark, scratch, 2003, many, "cnr string, court string, title string, decision_date string, pdf_link string")
    with open(path, "r+b") as f:  # a sound footer over a spoilt page
        f.seek(os.path.getsize(path) // 3)
        f.write(os.urandom(2000))
    out = run(spark, scratch)
    got = states(spark, scratch)
    assert {y: s[:2] for y, s in got.items()} == {"2000": ("finished", 1), "2001": ("failed", None), "2002": ("failed", None),
                                                  "2003": ("failed", None), "2004": ("finished", 1), "2005": ("finished", 1)}
    assert all(got[y][2] for y in ("2001", "2002", "2003"))
    assert {str(r.year) for r in spark.read.json(out.stats_path).collect()} == {"2000", "2004", "2005"}
    with pytest.raises(ValueError):
        metadata_partitions(spark, f"{scratch}/m")


def test_resume_takes_only_what_is_open(spark, scratch):
    store(spark, scratch)
    cut_short(spark, f"{scratch}/m/year=2001/court=c/bench=b/metadata.parquet")
    first = run(spark, scratch)
    store(spark, scratch, [2001])  # repaired
    second = run(spark, scratch, resume=True)
    assert {s[0] for s in states(spark, scratch).values()} == {"finished"}
    assert [str(r.year) for r in spark.read.parquet(second.stage_path).collect()] == ["2001"]
    runs = {str(r.year): r.process_id for r in spark.read.json(first.stats_path).collect()}
    assert len(set(runs.values())) == 2 and sum(i == runs["2001"] for i in runs.values()) == 1
    assert run(spark, scratch, resume=True) is None


def test_a_run_that_breaks_off_is_taken_up(spark, scratch):
    store(spark, scratch)

    def broken(text):
        raise RuntimeError("no embedder")

    with pytest.raises(RuntimeError):
        jobs.run_years(spark, f"{scratch}/m", objects(spark), f"{scratch}/out", "1", 2000, 2005, embedder=broken)
    assert {s[0] for s in states(spark, scratch).values()} == {"started"}
    run(spark, scratch, resume=True)
    assert {s[0] for s in states(spark, scratch).values()} == {"finished"}


def test_no_file(spark, scratch):
    assert run(spark, scratch) is None
    with pytest.raises(ValueError):
        metadata_partitions(spark, f"{scratch}/m")
    assert M.short_files(spark, spark.createDataFrame([], f"{M.FILE} string"), []).count() == 0
    assert ledger.states(spark, f"{scratch}/out").where(F.col("state") != "x").count() == 0
