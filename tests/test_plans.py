"""Physical-plan properties the design relies on at scale."""
import re

from lexcurate.plans import catalogue as C
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanged_columns(spark, df):
    """Input columns of every hash / range exchange in the formatted plan."""
    text = formatted(spark, df)
    out = []
    for block in re.split(r"\n\(\d+\) ", text):
        if block.startswith("Exchange") and "hashpartitioning" in block:
            m = re.search(r"Input \[\d+\]: \[([^\]]*)\]", block)
            if m:
                out.append([c.split("#")[0] for c in m.group(1).split(", ")])
    return out


def test_stage1_shuffles_no_text(spark):
    df = C.q_document_log(spark, SF_SMALL)
    cols = exchanged_columns(spark, df)
    assert cols, "expected a keyed exchange for the repair join"
    # repaired texts of garbled documents meet their keys; documents' own texts stay where they are
    assert all("text" not in c and "__text" not in c for c in cols), cols


def test_language_model_is_broadcast(spark):
    p = plan(C.q_detect_language(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_upsert_is_an_aggregate_not_a_window(spark):
    p = plan(C.q_metadata_upsert(spark, SF_SMALL))
    assert "max_by" in p and "Window" not in p


def test_run_header_is_broadcast(spark):
    from lexcurate.plans import indexing, standins as SI

    recs = indexing.lookup_and_chunk(SI.metadata(spark, SF_SMALL), C._objects(spark, SF_SMALL))
    text = formatted(spark, recs)
    # the run keys never appear as a shuffle key: the header join is a broadcast
    assert "hashpartitioning(year" not in text


def test_embedder_runs_once_per_row(spark):
    p = plan(C.q_vector_records(spark, SF_SMALL))
    assert p.count("ArrowEvalPython") == 1


def test_bucketed_objects_are_not_shuffled(spark):
    from lexcurate.plans import indexing, standins as SI
    from lexcurate.sinks.writers import write_objects_bucketed

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle join shape
    try:
        write_objects_bucketed(C._objects(spark, SF_SMALL), "objects_bucketed", 8)
        objs = spark.table("objects_bucketed")
        recs = indexing.lookup_and_chunk(SI.metadata(spark, SF_SMALL), objs)
        text = formatted(spark, recs)
        cols = exchanged_columns(spark, recs)
        assert "SortMergeJoin" in text
        assert all("text" not in c for c in cols), cols
        assert recs.count() == SI.metadata(spark, SF_SMALL).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS objects_bucketed")


def test_size_for_input(spark):
    from lexcurate.session import size_for_input

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = size_for_input(spark, 100 * (1 << 40))  # 100 TB
        maps = 100 * (1 << 40) / int(got["spark.sql.files.maxPartitionBytes"])
        # a shuffle has maps x reducers blocks; the driver holds a size for each
        assert int(got["spark.sql.shuffle.partitions"]) <= 20_000 and maps <= 250_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_keys_are_combined_map_side(spark):
    """One case number / one run holding a third of all rows: both reductions
    are partial aggregates inside each task before the shuffle."""
    from pyspark.sql import functions as F

    from lexcurate.operators import stats, upsert

    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), F.col("id").cast("string"))).alias("pk"),
        F.lit("HC_DOC_METADATA").alias("sk"), F.col("id").cast("string").alias("s3_key"),
        F.col("id").alias("v"))
    latest = upsert.latest(rows, ["pk", "sk"], ["s3_key"])
    assert "partial_max_by" in plan(latest)
    assert latest.count() == 1 + 2 * n // 3

    recs = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("1999")).otherwise((F.col("id") % 50).cast("string")).alias("year"),
        F.lit("c").alias("court_code"), F.lit("b").alias("bench"), F.lit("X").alias("court_name"),
        F.lit("success").alias("outcome"), F.lit(True).alias("has_cnr"),
        F.lit(10).cast("long").alias("token_count"), F.lit(1).cast("long").alias("chunk_count"))
    st = stats.run_stats(recs)
    p = plan(st)
    assert "partial_count" in p and "partial_sum" in p
    hot = st.where(F.col("year") == "1999").first()
    assert hot.total_documents_attempted == n // 3  # other rows have years "0".."49"


def test_hot_object_key_is_dealt_over_tasks(spark, monkeypatch):
    """A third of all records name one object: no task gets more than twice the median of rows."""
    from pyspark.sql import functions as F

    from lexcurate.operators.lookup import look_up, one_row_a_key

    n = 6000
    recs = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("s3_key"))
    objs = recs.select("s3_key").distinct().where("s3_key <> 'k7'").select("s3_key", F.lit("text").alias("__text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for most in (1 << 20, 0):  # heavy objects by broadcast, and by shuffle
            looked = look_up(recs, one_row_a_key(objs, "s3_key"), "s3_key", most)
            assert looked.count() == n and [r.s3_key for r in looked.where("__text IS NULL").collect()] == ["k7"]
            tasks = looked.where("s3_key = 'hot'").groupBy(F.spark_partition_id().alias("task")).count().collect()
            shares = sorted(r["count"] for r in tasks)
            assert sum(shares) == n / 3 and shares[-1] < n / 8 and (not most or len(shares) == 8 and shares[-1] <= 2 * shares[4])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_aggregate_between_exchange_and_lookup_join(spark):
    from pyspark.sql import functions as F

    from lexcurate.operators.lookup import look_up, one_row_a_key

    recs = spark.range(50).select(F.col("id").cast("string").alias("s3_key"))
    objs = recs.withColumn("__text", F.lit("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(look_up(recs, one_row_a_key(objs, "s3_key"), "s3_key"))
        assert "SortMergeJoin" in p and "Aggregate" not in p
        twice = one_row_a_key(objs.union(objs.limit(3).withColumn("__text", F.lit("z"))), "s3_key")
        assert twice.count() == 50 and twice.where("__text = 'z'").count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
