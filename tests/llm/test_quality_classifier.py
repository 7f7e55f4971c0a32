import zlib

import numpy as np

from lexcurate.llm import common, quality

SF = "/root/testdata/sf0.1"


def test_descent_reaches_the_hinge_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 5))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.where(x[:, 0] + 0.1 * rng.normal(size=60) > 0, 1, -1)
    rows = [np.arange(5)] * 60
    w = quality.descend(rows, list(x), y, 5, epochs=400)

    def loss(w):
        return 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w[:5] + w[5])).sum()

    assert all(loss(w) <= loss(w + 0.02 * rng.normal(size=6)) + 1e-3 for _ in range(300))


def test_held_out_accuracy(spark):
    docs, labels = common.documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.classify(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    right = np.mean([r.predicted == r.quality for r in rows])
    kept = np.mean([r.predicted for r in rows if r.quality == 1])
    caught = np.mean([1 - r.predicted for r in rows if r.quality == 0])
    assert len(rows) > 300 and right > 0.98 and kept > 0.99 and caught > 0.9, (right, kept, caught)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out.limit(200).collect())


def test_odd_rows(spark):
    rows = [(1, None, 1), (1, "", 1), (None, "good words here", 0), (2, "x" * 100_000, 0), (3, "a " * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    for labels in ([], [(1, 1), (1, None), (None, 0)], [(i, i % 2) for i in range(4)]):
        out = quality.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    none = docs.limit(0)
    assert quality.classify(none, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect() == []
    left = quality.keep_good(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert left.columns == docs.columns and left.count() == 5


def test_fit_takes_one_row_of_each_id_present(spark):
    rows = [(i, f"{'good' if i % 2 else 'bad'} word{i} here") for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    absent = spark.range(10_000, 30_000).selectExpr("id AS doc_id", "1 AS quality")
    want = quality.train(docs, labels, 20)
    assert want["constant"] is None
    assert np.array_equal(quality.train(docs, labels.union(absent), 20)["ratio"], want["ratio"])
    assert np.array_equal(quality.train(docs.union(docs).union(docs), labels, 20)["ratio"], want["ratio"])
