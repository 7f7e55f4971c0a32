from lexcurate.llm import url_filters

ENTRIES = [("block", "host", "a.b.example", 10, "add"), ("block", "host", "a.b.example", 20, "remove"), ("block", "host", "a.b.example", 15, "add"),
           ("block", "host", "a.b.example", 15, "add"), ("block", "domain", "b.example", 5, "add"), ("allow", "prefix", "a.b.example/x", 12, "add"),
           ("allow", "prefix", "a.b.example/x", 30, "add"), ("allow", "prefix", "a.b.example/x", 30, "remove"),
           ("block", "url", "a.b.example/x/y", 13, "add"), ("block", "domain", "example", None, "add"), (None, "host", "n.example", 1, "add"),
           ("block", "host", None, 1, "add"), ("block", "host", "n.example", 1, "rename")]
CAPTURES = [  # url, day, verdict, pattern
    ("http://a.b.example/", 9, "block", "b.example"), ("HTTPS://WWW.A.b.example.:80/z?q#f", 10, "block", "a.b.example"),
    ("http://a.b.example", 19, "block", "a.b.example"), ("http://a.b.example", 20, "block", "b.example"), ("http://a.b.example", 4, "none", None),
    ("http://u:p@a.b.example/x/", 12, "allow", "a.b.example/x"), ("http://a.b.example/xy", 12, "block", "a.b.example"),
    ("http://a.b.example/x/y?z=1", 13, "block", "a.b.example/x/y"), ("http://a.b.example/x/y/z", 13, "allow", "a.b.example/x"),
    ("http://a.b.example/x", 30, "block", "b.example"), ("http://ab.example/x", 30, "none", None), ("http://n.example/", 30, "none", None),
    (None, 30, "none", None), ("http://a.b.example", None, "none", None), ("", 30, "none", None), ("not a url", 30, "none", None),
    ("http://" + "x." * 3000 + "b.example/" + "p/" * 500, 30, "block", "b.example"), ("http:///x", 30, "none", None),
    ("http://a.b.example", 20, "block", "b.example")]


def frames(spark, captures=CAPTURES, entries=ENTRIES):
    c = spark.createDataFrame([(i, u, d, "x") for i, (u, d, *_) in enumerate(captures)], "page_id long, url string, day int, list string")
    return c, spark.createDataFrame([(*e, 1) for e in entries], "list string, kind string, pattern string, day int, action string, page_id int")


def test_verdicts_at_fetch_time(spark):
    out = url_filters.judge(*frames(spark)).collect()
    assert {(r.page_id, r.verdict, r.pattern) for r in out} == {(i, v, p) for i, (_, _, v, p) in enumerate(CAPTURES)}
    assert len(out) == len(CAPTURES)


def test_intervals(spark):
    got = {tuple(r) for r in url_filters.intervals(frames(spark)[1]).collect()}
    assert got == {("block", "host", "a.b.example", 10, 20), ("block", "domain", "b.example", 5, None),
                   ("allow", "prefix", "a.b.example/x", 12, 30), ("block", "url", "a.b.example/x/y", 13, None)}


def test_empty_tables(spark):
    captures, entries = frames(spark)
    assert url_filters.judge(captures.limit(0), entries).collect() == []
    assert {r.verdict for r in url_filters.judge(captures, entries.limit(0)).collect()} == {"none"}


def test_prefixes_of_any_depth(spark):
    nine, twelve = "h.example/" + "/".join("abcdefghi"), "h.example/" + "/".join("abcdefghijkl")
    entries = [("block", "host", "h.example", 1, "add"), ("allow", "prefix", nine, 5, "add"), ("block", "prefix", twelve, 7, "add")]
    captures = [(f"http://{nine}/z", 4, "block", "h.example"), (f"http://{nine}/z", 5, "allow", nine), (f"http://{nine}", 5, "allow", nine),
                (f"http://{nine}z", 5, "block", "h.example"), (f"http://{twelve}/z", 6, "allow", nine), (f"http://{twelve}/z", 7, "block", twelve)]
    out = url_filters.judge(*frames(spark, captures, entries)).collect()
    assert {(r.page_id, r.verdict, r.pattern) for r in out} == {(i, v, p) for i, (_, _, v, p) in enumerate(captures)}
