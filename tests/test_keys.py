import datetime

from pyspark.sql import functions as F

from lexcurate.functions import keys as K
from lexcurate.operators import metadata as M
from lexcurate.plans import indexing


def test_key_year_string_dates(spark):
    df = spark.createDataFrame([("2020-01-05",), ("2020-1-5",), ("05-01-2020",), ("",), (None,), ("garbage",)],
                               "d string")
    got = [r[0] for r in df.select(K.key_year(F.col("d"), F.lit("1999"))).collect()]
    assert got == ["2020", "2020", "1999", "None", "None", "1999"]


def test_key_year_typed_dates(spark):
    df = spark.createDataFrame([(datetime.date(2011, 3, 4),), (None,)], "d date")
    assert [r[0] for r in df.select(K.key_year(F.col("d"), F.lit("1999"), "date")).collect()] == ["2011", "None"]


def test_links_names_and_skip(spark):
    df = spark.createDataFrame([("a/b/c.pdf",), ("a/b/",), ("",), (None,)], "l string")
    rows = df.select(K.file_name("l").alias("f"), K.skip_link("l").alias("s")).collect()
    assert [(r.f, r.s) for r in rows] == [("c.pdf", False), ("", True), ("None", False), ("None", False)]


def test_court_names(spark):
    df = spark.createDataFrame([("High Court -- A B",), (None,)], "c string")
    rows = df.select(K.court_name("c").alias("n"), K.index_name("c").alias("i"),
                     K.court_path_name("c").alias("p")).collect()
    assert (rows[0].n, rows[0].i, rows[0].p) == ("High-Court----A-B", "high-court--a-b", "High-Court--A-B")
    assert rows[1].n == "unknown-court"


def test_log_year_and_prefix(spark):
    df = spark.createDataFrame([("processing_log_1995.jsonl",)], "n string")
    assert df.select(K.year_from_log_name("n")).first()[0] == "1995"
    assert df.select(K.partition_prefix(F.lit("2001"), F.lit("16~20"))).first()[0] == "data/pdf/year=2001/court=16~20/"


def test_items_projection(spark):
    df = spark.createDataFrame(
        [("C1", "t", datetime.date(2020, 1, 5), datetime.datetime(2020, 1, 5, 10, 0, 1), "<p>", "k")],
        "CNR string, title string, date_of_registration date, decision_date timestamp, raw_html string, s3_key string")
    row = M.items(df, cnr_col="cnr").first().asDict()
    assert row == {"pk": "C1", "sk": "HC_DOC_METADATA", "title": "t", "date_of_registration": "2020-01-05",
                   "decision_date": "2020-01-05T10:00:01", "s3_key": "k"}


def test_keyed_records_object_key(spark):
    df = spark.createDataFrame([("2017", "16~20", "taphc", "2017-03-02", "x/y/doc.pdf", "c", "n")],
                               "year string, court_code string, bench string, decision_date string, pdf_link string,"
                               " cnr string, court string")
    r = indexing.keyed_records(df).first()
    assert r.s3_key == "data/pdf/year=2017/court=16~20/bench=taphc/doc.pdf" and not r.skipped


def test_key_year_takes_what_strptime_takes(spark):
    from pyspark.sql import functions as F

    from lexcurate.functions.keys import key_year

    given = {"2020-01-05": "2020", "2020-1-5": "2020", "2020-001-05": "run", "0000-01-01": "run", "20-01-05": "run", "2020-02-30": "run",
             "2020-13-01": "run", "": "None"}
    df = spark.createDataFrame([(d,) for d in given], "d string")
    assert {r.d: r.y for r in df.select("d", key_year(F.col("d"), F.lit("run")).alias("y")).collect()} == given
