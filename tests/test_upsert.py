import os

from lexcurate.operators.upsert import latest, manifest, read_table, upsert_table
from lexcurate.sinks import writers


def test_latest_newest_wins_nulls_lowest(spark):
    df = spark.createDataFrame([("k", None, "a", 1), ("k", "2020-01-01", "b", 2), ("k", "2019-01-01", "c", 3),
                                ("j", None, "d", 4)], "key string, d string, s string, v int")
    got = {r.key: (r.s, r.v) for r in latest(df, ["key"], ["d", "s"]).collect()}
    assert got == {"k": ("b", 2), "j": ("d", 4)}


def test_a_later_batch_wins_whatever_its_dates(spark, scratch):
    schema = "pk string, sk string, decision_date string, s3_key string, v int"
    first = spark.createDataFrame([("a", "s", "1999-01-01", "k1", 1), ("b", "s", "31-12-1990", "k1", 2), ("b", "s", "2020-05-01", "k2", 3)], schema)
    later = spark.createDataFrame([("a", "s", "1990-01-01", "k0", 4)], schema)
    writers.write_items(spark, first, scratch, "1")
    path = writers.write_items(spark, later, scratch, "2", "1")
    assert sorted((r.pk, r.v) for r in read_table(spark, path).collect()) == [("a", 4), ("b", 3)]


def test_upsert_is_idempotent(spark, scratch):
    batch = spark.createDataFrame([("k1", "2020", "x"), ("k2", "2021", "y"), ("k1", "2022", "z")],
                                  "key string, d string, v string")
    upsert_table(spark, batch, scratch, "1", ["key"], ["d"])
    upsert_table(spark, batch, scratch, "2", ["key"], ["d"], current_version="1")
    v1 = sorted(tuple(r) for r in read_table(spark, f"{scratch}/v=1").collect())
    v2 = sorted(tuple(r) for r in read_table(spark, f"{scratch}/v=2").collect())
    assert v1 == v2 == [("k1", "2022", "z"), ("k2", "2021", "y")]


def test_only_units_with_incoming_keys_are_written(spark, scratch):
    schema = "index_name string, key string, d string, v int"
    first = [(f"i{i % 3}", f"k{i}", "2020", i) for i in range(300)]
    one = upsert_table(spark, spark.createDataFrame(first, schema), scratch, "1", ["index_name", "key"], ["d"], partition_by=["index_name"])
    files = {os.path.join(d, n): os.path.getmtime(os.path.join(d, n)) for d, _, names in os.walk(f"{scratch}/files") for n in names}
    later = spark.createDataFrame([("i1", "k1", "1990", -1), ("i1", "k301", "1990", -2), ("a/b=c d", "x", None, -3)], schema)
    two = upsert_table(spark, later, scratch, "2", ["index_name", "key"], ["d"], partition_by=["index_name"], current_version="1")
    assert sorted(tuple(r) for r in read_table(spark, one).select("index_name", "key", "d", "v").collect()) == sorted(first)
    want = [r for r in first if r[1] != "k1"] + [("i1", "k1", "1990", -1), ("i1", "k301", "1990", -2), ("a/b=c d", "x", None, -3)]
    assert {tuple(r) for r in read_table(spark, two).select("index_name", "key", "d", "v").collect()} == set(want)
    versions = [r["__version"] for r in manifest(spark, two).collect()]
    assert versions.count("2") <= 3 and versions.count("1") == manifest(spark, one).count() - (versions.count("2") - 1)
    assert all(os.path.getmtime(f) == t for f, t in files.items())  # the first version's files, untouched
    again = upsert_table(spark, later, scratch, "2", ["index_name", "key"], ["d"], partition_by=["index_name"], current_version="1")
    assert {tuple(r) for r in read_table(spark, again).select("index_name", "key", "d", "v").collect()} == set(want)
    plan = read_table(spark, two).where("index_name = 'i0'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(index_name" in plan


def test_new_and_missing_columns_and_empty_batches(spark, scratch):
    a = spark.createDataFrame([("a", "1", "x")], "key string, d string, old string")
    b = spark.createDataFrame([("b", "1", 7)], "key string, d string, fresh int")
    upsert_table(spark, a.limit(0), scratch, "0", ["key"], ["d"])
    assert read_table(spark, f"{scratch}/v=0").collect() == []
    upsert_table(spark, a, scratch, "1", ["key"], ["d"], current_version="0")
    upsert_table(spark, b, scratch, "2", ["key"], ["d"], current_version="1")
    path = upsert_table(spark, b.limit(0), scratch, "3", ["key"], ["d"], current_version="2")
    got = {r.key: (r.old, r.fresh) for r in read_table(spark, path).collect()}
    assert got == {"a": ("x", None), "b": (None, 7)}


def test_a_hot_key_is_one_row(spark, scratch):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) key", "cast(id as string) d", "id v")
    path = upsert_table(spark, rows, scratch, "1", ["key"], ["v"])
    path = upsert_table(spark, rows.withColumn("v", rows.v + 1), scratch, "2", ["key"], ["v"], current_version="1")
    table = read_table(spark, path)
    assert table.count() == 2001 and table.where("key = 'hot'").first().v == 2998
