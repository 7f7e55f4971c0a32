import re

import pytest
from pyspark.sql import functions as F

from lexcurate.llm import common, exact_dedup

ROWS = [(1, "a b", "x"), (2, "ab", "x"), (3, "a\tb\n", None), (4, None, "y"), (5, " \x0b\x0c", "y"), (6, "a b", "z"),
        (7, "x" * 50_000, None), (8, "x" * 50_000, None), (9, "a  b", "q"), (10, "", "q"), (11, "é", ""), (12, "é", "")]


def brute(rows):
    groups = {}
    for d, t, _ in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), d))
    return sorted((d, min(g)[1], len(g), min(g)[1] == d) for g in groups.values() for _, d in g)


@pytest.mark.parametrize("letters", [64, 1, 0])
def test_groups_also_where_digests_collide(spark, letters):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, digest string").repartition(3)
    out = exact_dedup.exact_dedup(docs, lambda sha: F.substring(sha, 1, letters))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out.collect()) == brute(ROWS)


def test_several_micro_batches(spark):
    rows = [(i, f"t{i % 7}", None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string").repartition(9)
    before = exact_dedup.FILES_A_BATCH
    exact_dedup.digest_state.__defaults__ = (2,)
    try:
        out = exact_dedup.exact_dedup(docs).collect()
    finally:
        exact_dedup.digest_state.__defaults__ = (before,)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out) == brute(rows)


def test_repeated_and_null_ids_leave_one(spark):
    rows = [(1, "a", 1), (1, "a", 2), (None, "a", 3), (None, "b", 4), (None, "b", 5), (2, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    out = exact_dedup.exact_dedup(docs).collect()
    assert len(out) == 6 and sum(r.kept for r in out) == 3
    assert {r.keep_id for r in out if r.group_size == 3} == {1}
    left = exact_dedup.keep_one(docs)
    assert left.columns == docs.columns and sorted(r.text or "" for r in left.collect()) == ["", "a", "b"]


def test_empty(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_native_plan(spark):
    out = exact_dedup.op5_exact_dedup(spark, "/root/testdata/sf0.001")
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())
    assert out.count() == 200


def test_state_has_small_write_buffers(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB"
    with exact_dedup._rocksdb(spark):
        assert 0 < int(spark.conf.get(key, "-1")) <= 2
    assert spark.conf.get(key, None) is None
