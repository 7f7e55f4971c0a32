"""No content is embedded twice."""
import pandas as pd
from pyspark.sql import functions as F

from lexcurate.operators import embedding_store as E
from lexcurate.plans import jobs, standins as SI
from lexcurate.plans.catalogue import _objects
from lexcurate.operators.upsert import read_table
from tests.conftest import SF_SMALL


def counting(spark):
    """(embedder, accumulator of the contents it was given)."""
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<float>")
    def embed(text: pd.Series) -> pd.Series:
        calls.add(len(text))
        return text.map(lambda t: [float(len(t)), 1.0] if t.strip() else None)

    return embed.asNondeterministic(), calls


def test_each_content_once(spark, scratch):
    embedder, calls = counting(spark)
    rows = [("a", "one"), ("b", "two"), ("c", "one"), ("d", " "), ("e", None)] + [(f"h{i}", "hot") for i in range(300)]
    chunks = spark.createDataFrame(rows, "id string, content string").repartition(5)
    first = {r.id: r.data for r in E.embedded(chunks, embedder, scratch).collect()}
    assert first == {i: [float(len(t)), 1.0] if (t or "").strip() else None for i, t in rows}
    assert calls.value == 4  # one, two, hot, and the blank that can't be embedded
    more = chunks.union(spark.createDataFrame([("f", "three"), ("g", "two")], chunks.schema))
    second = {r.id: r.data for r in E.embedded(more, embedder, scratch).collect()}
    assert second == first | {"f": [5.0, 1.0], "g": [3.0, 1.0]} and calls.value == 6  # three, and the blank again
    assert E.stored(spark, scratch, "default").count() == 4
    assert E.stored(spark, scratch, "other").count() == 0


def test_a_digest_stored_twice_gives_one_row(spark, scratch):
    embedder, _ = counting(spark)
    chunks = spark.createDataFrame([("a", "one")], "id string, content string")
    E.embedded(chunks, embedder, scratch)
    E.stored(spark, scratch, "default").write.mode("append").parquet(f"{scratch}/copy")
    spark.read.parquet(f"{scratch}/copy").write.mode("append").parquet(f"{scratch}/model=default")
    assert E.embedded(chunks, embedder, scratch).count() == 1


def test_a_second_run_embeds_no_chunk(spark, scratch):
    embedder, calls = counting(spark)
    meta, objects = SI.metadata(spark, SF_SMALL), _objects(spark, SF_SMALL)
    one = jobs.run_indexing(spark, meta, objects, f"{scratch}/out", "1", embedder=embedder, embedding_store=f"{scratch}/store")
    before = calls.value
    stored = E.stored(spark, f"{scratch}/store", "default").count()
    blank = before - stored
    two = jobs.run_indexing(spark, meta, objects, f"{scratch}/out", "2", current_version="1", embedder=embedder, embedding_store=f"{scratch}/store")
    assert stored > 0 and calls.value - before == blank == 0
    rows = [{(r.key, tuple(r.data)) for r in read_table(spark, o.vectors_path).collect()} for o in (one, two)]
    assert rows[0] == rows[1]


def test_embedder_hashes_each_distinct_token_once(spark):
    """Equal to the plain definition for null, blank and repeated contents, and the tokens aren't hashed one by one in the plan."""
    import hashlib

    from lexcurate.operators.embedding import hashing_embedder

    texts = [None, "", "  ", "a b a.", "é 中 a-b " * 300, "x " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1).select("i", "t", hashing_embedder(16)(F.col("t")).alias("e"))
    assert "md5" not in df._jdf.queryExecution().toString()
    for r in df.collect():
        tokens = [] if not r.t else {3: ["a", "b", "a", "."], 4: ["é", "中", "a", "-", "b"] * 300, 5: ["x"] * 5000}.get(r.i, [])
        counts = [0] * 16
        for t in tokens:
            counts[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 16] += 1
        norm = sum(c * c for c in counts) ** 0.5
        assert (r.e is None) if not tokens else all(abs(x - c / norm) < 1e-6 for x, c in zip(r.e, counts))
