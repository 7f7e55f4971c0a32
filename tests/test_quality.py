
from lexcurate.operators import langid, quality


def log_for(spark, docs, repaired=None, **kw):
    d = spark.createDataFrame(docs, "key string, text string, lang string")
    r = spark.createDataFrame(repaired, "key string, text string, lang string") if repaired is not None else None
    out = quality.assess(d, langid.GivenLanguage("lang"), r, **kw)
    return {row.key: row for row in out.collect()}


GOOD = "the court heard the appeal and found the reasons sound"
BAD = "xq zv bcd fgh"


def test_gate_and_status_cases(spark):
    docs = [("ok", GOOD, "fr"),            # high ratio, other language: not garbled
            ("lowallowed", BAD, "en"),     # low ratio, allowed language: not garbled
            ("lowother", BAD, "fr"),       # low ratio, other language: garbled, repaired ok
            ("lownull", BAD, None),        # null language counts as not allowed: repaired, still garbled
            ("blank", "   ", "en"),        # blank: garbled, no repair -> ocr_failed
            ]
    rep = [("lowother", GOOD, "en"), ("lownull", GOOD, "fr"), ("ok", GOOD, "en")]
    log = log_for(spark, docs, rep, min_ratio=0.6, allowed_langs="en, hi")
    assert log["ok"].status == "ok_no_ocr" and not log["ok"].did_ocr and log["ok"].word_ratio_after is None
    assert log["lowallowed"].status == "ok_no_ocr"
    assert log["lowother"].status == "ok_after_ocr" and log["lowother"].did_ocr
    assert log["lownull"].status == "ocr_done_but_still_garbled"
    assert log["blank"].status == "ocr_failed" and log["blank"].lang_before.lang is None
    assert log["blank"].lang_before.prob == 0.0
    assert len(log) == len(docs)


def test_type_on_pre_repair_text_and_curation(spark):
    docs = [("a", "JUDGMENT " + BAD, "fr"), ("b", "JUDGMENT " + GOOD, "en"), ("c", "   ", "en")]
    rep = [("a", GOOD, "en"), ("c", "JUDGMENT " + GOOD, "en")]
    d = spark.createDataFrame(docs, "key string, text string, lang string")
    r = spark.createDataFrame(rep, "key string, text string, lang string")
    log = quality.assess(d, langid.GivenLanguage("lang"), r)
    cur = sorted(x.key for x in quality.curated(log).collect())
    assert cur == ["a", "b"]  # c is typed on its (blank) pre-repair text: order, never curated
    after = quality.assess(d, langid.GivenLanguage("lang"), r, classify_on="after")
    assert sorted(x.key for x in quality.curated(after).collect()) == ["a", "b", "c"]


def test_fetch_failure_row(spark):
    d = spark.createDataFrame([("k", None, None, "NoSuchKey")], "key string, text string, lang string, err string")
    row = quality.assess(d, langid.GivenLanguage("lang"), None, fetch_error_col="err").first()
    assert row.status == "download_failed: NoSuchKey" and row.doc_type is None and row.word_ratio_before is None


def test_restricted_repairs_same_log(spark):
    from lexcurate.plans import standins as SI
    from tests.conftest import SF_SMALL

    docs = SI.stage1_objects(spark, SF_SMALL)
    rep = SI.repaired_text(spark, SF_SMALL)
    kw = dict(min_ratio=SI.TEST_MIN_RATIO, allowed_langs=SI.TEST_ALLOWED)
    a = quality.assess(docs, langid.GivenLanguage("lang"), rep, **kw)
    b = quality.assess(docs, langid.GivenLanguage("lang"), rep, restrict_repairs=True, **kw)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
