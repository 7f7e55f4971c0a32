"""K1: documents put by key; only touched files are rewritten; runs that break off."""
import os

import pytest
from pyspark.sql import functions as F

from lexcurate.sinks import keyed

PARTS = ["year", "court"]


def batch(spark, rows):
    return spark.createDataFrame(rows, "key string, year string, court string, text string")


def held(spark, path):
    return sorted((r.key, r.year, r.court, r.text) for r in spark.read.parquet(path).collect())


def files(path):
    return {os.path.join(d, n): os.path.getmtime(os.path.join(d, n)) for d, _, names in os.walk(path)
            for n in names if n.endswith(".parquet") and keyed.JOURNAL not in d}


def test_later_runs_replace_their_keys_alone(spark, scratch):
    path = f"{scratch}/store"
    first = [(f"k{i}", str(2000 + i % 2), "c", f"one {i}") for i in range(20)]
    keyed.put(batch(spark, first), path, PARTS)
    assert held(spark, path) == sorted(first)
    keyed.put(batch(spark, [("k2", "2000", "c", "two"), ("new", "2001", "d", "two")]), path, PARTS)
    want = sorted([r for r in first if r[0] != "k2"] + [("k2", "2000", "c", "two"), ("new", "2001", "d", "two")])
    assert held(spark, path) == want
    keyed.put(batch(spark, [("k2", "2000", "c", "two"), ("new", "2001", "d", "two")]), path, PARTS)  # the same run again
    assert held(spark, path) == want


def test_untouched_files_stay_the_same(spark, scratch):
    path = f"{scratch}/store"
    spread = batch(spark, [(f"k{i}", "2000", "c", f"one {i}") for i in range(40)]).repartition(4, "key")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keyed.put(spread, path, PARTS)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    before = files(path)
    assert len(before) == 4
    touched = spark.read.parquet(path).where("key = 'k7'").select("_metadata.file_name").first()[0]
    keyed.put(batch(spark, [("k7", "2000", "c", "two")]), path, PARTS)
    after = files(path)
    assert {os.path.basename(f) for f in before if f not in after} == {touched}
    assert all(after[f] == t for f, t in before.items() if f in after)
    assert len(held(spark, path)) == 40


@pytest.mark.parametrize("step", ["write", "published", "drop"])
def test_a_run_that_breaks_off(spark, scratch, monkeypatch, step):
    path = f"{scratch}/store"
    first = [(f"k{i}", "2000", "c", f"one {i}") for i in range(6)]
    keyed.put(batch(spark, first), path, PARTS)
    with monkeypatch.context() as m:
        if step == "write":  # in the middle of its tasks
            fail = F.udf(lambda t: 1 // 0 if t == "two" else t)
            with pytest.raises(Exception):
                keyed.put(batch(spark, [("k1", "2000", "c", "two")]).withColumn("text", fail("text")), path, PARTS)
        elif step == "published":  # new files are there, the mark isn't
            make, calls = spark.createDataFrame, []

            def once(*a, **k):
                calls.append(a)
                if len(calls) == 2:
                    raise RuntimeError("lost")
                return make(*a, **k)

            new = batch(spark, [("k1", "2000", "c", "two")])
            m.setattr(type(spark), "createDataFrame", lambda self, *a, **k: once(*a, **k))
            with pytest.raises(RuntimeError):
                keyed.put(new, path, PARTS)
        else:  # marked, the old files are still there
            def lost(*a):
                raise RuntimeError("lost")

            m.setattr(keyed, "_drop_replaced", lost)
            with pytest.raises(RuntimeError):
                keyed.put(batch(spark, [("k1", "2000", "c", "two")]), path, PARTS)
    keyed.recover(spark, path, PARTS)
    text = "two" if step == "drop" else "one 1"
    assert held(spark, path) == sorted(r if r[0] != "k1" else ("k1", "2000", "c", text) for r in first)
    keyed.put(batch(spark, [("k1", "2000", "c", "two")]), path, PARTS)
    assert held(spark, path) == sorted(r if r[0] != "k1" else ("k1", "2000", "c", "two") for r in first)
    assert not os.listdir(f"{path}/{keyed.JOURNAL}")


def test_columns_and_null_partitions(spark, scratch):
    path = f"{scratch}/store"
    keyed.put(batch(spark, [("a", None, "c", "one")]), path, PARTS)
    keyed.put(batch(spark, [("b", "2001", "c", None)]).withColumn("content", F.lit(b"x")), path, PARTS)
    keyed.put(batch(spark, []), path, PARTS)
    rows = {r.key: r for r in spark.read.option("mergeSchema", "true").parquet(path).collect()}
    assert rows["a"].year == "None" and rows["a"].content is None and bytes(rows["b"].content) == b"x"
