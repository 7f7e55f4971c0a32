"""Per-run statistics from per-record outcomes.

Every counter is an aggregate that Spark combines map-side (``count_if``,
``sum``, ``min``, ``max``), so a run holding a third of all records costs one
partial row per task before the shuffle. The reference's list-valued fields
(titles, token counts, chunk counts, failed files) are kept as rows of their
own tables (``titles``, ``failed_files``, per-record counts), never collected
into one array per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.plans.indexing import (EMPTY_TEXT, EXTRACTION_ERROR, FAILURES, KEY_NOT_FOUND, RUN_KEYS, SKIPPED,
                                      SUCCESS)


#: Size of a sketch, and the rank error that goes with it (99 % of the time a quantile's rank is off by less).
SKETCH_K, RANK_ERROR = 400, 0.01


def distribution(stats: DataFrame, by: list[str], ranks: list[float], count: str = "token") -> DataFrame:
    """A3 / A8 over any runs: (``by``, rank, n, quantile) from the merged sketches of their statistics records.

    ``count``: ``token`` or ``chunk``. Records read back from JSON hold a sketch as base64 text. Each
    quantile's rank is within RANK_ERROR of the rank asked for; groups without a successful document have no rows."""
    sketch = F.col(f"{count}_sketch")
    held = stats.withColumn("__sketch", F.unbase64(sketch) if stats.schema[f"{count}_sketch"].dataType.typeName() == "string" else sketch)
    # the sketch of a run without a successful document is null or empty
    merged = held.where(F.col("__sketch").isNotNull() & (F.kll_sketch_get_n_bigint("__sketch") > 0)) \
        .groupBy(*by).agg(F.kll_merge_agg_bigint("__sketch", SKETCH_K).alias("s"))
    at = [F.struct(F.lit(float(r)).alias("rank"), F.kll_sketch_get_quantile_bigint("s", F.lit(float(r))).alias("quantile")) for r in ranks]
    return merged.select(*by, F.kll_sketch_get_n_bigint("s").alias("n"), F.inline(F.array(*at))).select(*by, "rank", "n", "quantile")


def run_stats(records: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """One row per (year, court_code, bench, court_name).

    The output field names are fixed values: they are the counters of the
    reference's statistics record, kept so existing readers of it still work.
    """
    o = F.col("outcome")
    ok = o == SUCCESS
    counted = records.where(o != SKIPPED)
    per_run = counted.groupBy(*RUN_KEYS, "court_name").agg(
        F.count(F.lit(1)).alias("total_documents_attempted"),
        F.count_if(ok).alias("successful_documents"),
        F.count_if(o.isin(*FAILURES)).alias("failed_documents"),
        F.count_if(o == EMPTY_TEXT).alias("empty_text_documents"),
        F.count_if(o == KEY_NOT_FOUND).alias("keys_not_found"),
        F.count_if(o == EXTRACTION_ERROR).alias("pdf_extraction_errors"),
        F.count_if(ok & ~F.col("has_cnr")).alias("dynamodb_write_errors"),
        F.avg(F.when(ok, F.col("token_count"))).alias("avg_tokens_per_document"),
        F.sum(F.when(ok, F.col("token_count"))).alias("total_tokens"),
        F.min(F.when(ok, F.col("token_count"))).alias("min_tokens"),
        F.max(F.when(ok, F.col("token_count"))).alias("max_tokens"),
        F.avg(F.when(ok, F.col("chunk_count"))).alias("avg_chunks_per_document"),
        F.sum(F.when(ok, F.col("chunk_count"))).alias("total_chunks"),
        *[F.kll_sketch_agg_bigint(F.when(ok, F.col(f"{c}_count").cast("long")), SKETCH_K).alias(f"{c}_sketch") for c in ("token", "chunk")],
    )
    if chunks is not None:
        refused = F.col("upload_error") if "upload_error" in chunks.columns else F.lit(None).cast("string")
        errs = chunks.groupBy(*RUN_KEYS).agg(
            F.count_if(F.col("data").isNull()).alias("embedding_generation_errors"),
            # an embedded chunk that the vector store did not take
            F.count_if(F.col("data").isNotNull() & refused.isNotNull()).alias("s3_upload_errors"))
        per_run = per_run.join(errs, RUN_KEYS, "left")
    else:
        per_run = per_run.withColumns({c: F.lit(None).cast("long") for c in ("embedding_generation_errors", "s3_upload_errors")})
    per_run = per_run.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long")
                                   for c in ("embedding_generation_errors", "s3_upload_errors")})
    denom = F.col("total_documents_attempted") - F.col("keys_not_found")
    return per_run.withColumn(
        "success_rate_percent",
        F.when(denom > 0, F.col("successful_documents") / denom * F.lit(100.0)),
    )


def titles(records: DataFrame) -> DataFrame:
    """A6 / K5 rows: one title per successful document (nulls and duplicates kept)."""
    return records.where(F.col("outcome") == SUCCESS).select(*RUN_KEYS, "court_name", "s3_key",
                                                             F.col("run_title").alias("title"))


def failed_files(records: DataFrame) -> DataFrame:
    """A7 rows: {filename, error, error_message} of every failed document."""
    return records.where(F.col("outcome").isin(*FAILURES)).select(
        *RUN_KEYS, "court_name", "s3_key", "filename", F.col("outcome").alias("error"), "error_message")
