"""Exact top-k search by multi-resolution segment statistics.

A vector is described at each resolution by the mean and the deviation of its
segments. Over segments of length L, sum L ((m_q - m_v)^2 + (s_q - s_v)^2) is a
lower bound of the squared distance of q and v, so (|q|^2 + |v|^2 - bound) / 2 is an
upper bound of their inner product. Candidates go from four segments to
sixteen to exact integer products, and leave as soon as their bound is below the
query's k-th best score so far. Coarse bounds of a run of candidates are one matrix product; so are the
scores while most pairs are still open. Nothing is approximate: bounds have slack for rounding, scores are
integers that their type holds.

Queries (a stated set) and candidates are dealt into blocks; a task gets one block
of each and returns the block's k best a query; a window over these ranks them.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component take no part; only vectors of one dimension are compared; a row's
own vec_id is never its candidate, so rows that repeat it aren't either; each of
the repeated query rows is answered, ranked by itself; ties go to the
smaller vec_id; a row with a null vec_id is neither query nor candidate;
products beyond 64 bits saturate; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexcurate.llm import common

K, EVERY = 5, 50
RESOLUTIONS = (4, 16)
QUERY_BLOCK, CANDIDATE_BLOCK, STRIDE = 2048, 16_384, 1024


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """[rows, 2 * segments]: segment means and deviations, times the root of the segment's length."""
    parts = np.array_split(x, min(segments, x.shape[1]), axis=1)
    root = [math.sqrt(p.shape[1]) for p in parts]
    return np.stack([p.mean(1) * r for p, r in zip(parts, root)] + [p.std(1) * r for p, r in zip(parts, root)], 1)


def bound_factors(x: np.ndarray, stats: np.ndarray, left: bool) -> np.ndarray:
    """Rows whose products bound inner products from above: with |q - v|^2 >= |a - b|^2 for statistics a of q and b of v,
    q v <= a b + (|q|^2 - |a|^2) / 2 + (|v|^2 - |b|^2) / 2, which is one product of rows longer by two."""
    rest = ((x * x).sum(1) - (stats * stats).sum(1))[:, None] / 2
    one = np.ones((len(x), 1))
    return np.hstack([stats, rest, one] if left else [stats, one, rest])


class Pairs:
    """Products of rows of two matrices, for whole runs at once or for single pairs."""

    def __init__(self, a: np.ndarray, b: np.ndarray, kind: type):
        self.a, self.b = a.astype(kind), b.astype(kind)

    def table(self, rows, cols) -> np.ndarray:
        return self.a[rows] @ self.b[cols].T

    def at(self, rows: np.ndarray, cols: np.ndarray, numbers: int = 1 << 21) -> np.ndarray:
        out = np.empty(len(rows), self.a.dtype)
        most = max(1, numbers // self.a.shape[1])
        for i in range(0, len(rows), most):
            part = slice(i, i + most)
            out[part] = np.einsum("ij,ij->i", self.a[rows[part]], self.b[cols[part]])
        return out


def block_search(q_ids: np.ndarray, q: np.ndarray, v_ids: np.ndarray, v: np.ndarray, k: int = K,
                 stride: int = STRIDE, resolutions: tuple[int, ...] = RESOLUTIONS) -> tuple[np.ndarray, ...]:
    """(query row, vec_id, score) of each query's k best among ``v``; the rows hold integers as float64."""
    # every partial sum of a product stays below the product of the norms: exact in single precision up to 2^24
    most = np.sqrt((q * q).sum(1).max(initial=0)) * np.sqrt((v * v).sum(1).max(initial=0))
    exact = Pairs(q, v, np.float32 if most < 2.0 ** 23 else np.float64) if most < 2.0 ** 52 else None
    order = np.argsort(-(v * v).sum(1), kind="stable")  # long vectors first: they tend to score high and raise the floor
    best_q, best_v, best_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    floor = np.full(len(q), -np.inf)  # a query's k-th best score
    if exact:
        bounds = [Pairs(bound_factors(q, statistics(q, s), True), bound_factors(v, statistics(v, s), False), np.float32) for s in resolutions]
        slack = most * 1e-4 + 1e-6  # far above the rounding of a bound in single precision
    for block in (order[:stride // 16], *(order[i:i + stride] for i in range(stride // 16, len(v), stride))):
        allowed = q_ids[:, None] != v_ids[block][None, :]
        if exact is None:
            rows, cols = np.nonzero(allowed)
            wide = ((sum(int(x) * int(y) for x, y in zip(q[r], v[c]))) for r, c in zip(rows, block[cols]))
            scores = np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in wide], np.int64)
        else:
            every, rows = slice(None), None
            if np.isfinite(floor).all():
                low = (floor - slack).astype(np.float32)
                open_ = (bounds[0].table(every, block) >= low[:, None]) & allowed
                if open_.mean() < 1 / 8:  # few pairs are left: the finer bounds, then the products, pair by pair
                    rows, cols = np.nonzero(open_)
                    for finer in bounds[1:]:
                        keep = finer.at(rows, block[cols]) >= low[rows]
                        rows, cols = rows[keep], cols[keep]
                    scores = exact.at(rows, block[cols])
                    keep = scores >= floor[rows]
                    rows, cols, scores = rows[keep], cols[keep], scores[keep].astype(np.int64)
            if rows is None:
                table = exact.table(every, block)
                if len(block) > 4 * k:  # no more than the block's own k best (and their equals) can count
                    floor_here = np.maximum(floor, np.partition(np.where(allowed, table, -np.inf), len(block) - k, axis=1)[:, len(block) - k])
                else:
                    floor_here = floor
                rows, cols = np.nonzero((table >= floor_here[:, None]) & allowed)
                scores = table[rows, cols].astype(np.int64)
        best_q, best_v = np.concatenate([best_q, rows]), np.concatenate([best_v, v_ids[block[cols]]])
        best_s = np.concatenate([best_s, scores])
        top = np.lexsort((best_v, ~best_s, best_q))
        place = np.arange(len(top)) - np.searchsorted(best_q[top], best_q[top], "left")
        top = top[place < k]
        best_q, best_v, best_s = best_q[top], best_v[top], best_s[top]
        full, n = np.unique(best_q, return_counts=True)
        last = np.searchsorted(best_q, full, "right") - 1
        floor[full[n == k]] = best_s[last[n == k]]
        if exact is None:
            floor[:] = -np.inf
    return best_q, best_v, best_s


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``vectors`` and ``queries``: (vec_id, embedding). One row a result: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    n_v, n_q = vectors.count(), queries.count()
    v_blocks, q_blocks = max(1, -(-n_v // CANDIDATE_BLOCK)), max(1, -(-n_q // QUERY_BLOCK))

    def dealt(df: DataFrame, blocks: int):
        """Even blocks, whatever ids repeat; dimension and block name a group."""
        x = F.col("embedding")
        sound = F.forall(x, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < float("inf")) & ~F.isnan(e.cast("double")))
        return (df.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & sound)
                .select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("x"), F.size(x).alias("dimension"),
                        F.monotonically_increasing_id().alias("row")).withColumn("block", F.col("row") % blocks))

    left = dealt(queries, q_blocks).withColumnRenamed("block", "q_block").withColumn(
        "v_block", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1)).cast("array<long>")))
    right = dealt(vectors, v_blocks).withColumnRenamed("block", "v_block").withColumn(
        "q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)).cast("array<long>")))
    keys = ["dimension", "q_block", "v_block"]

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        q, v = (np.floor(256.0 * np.stack(d["x"].to_numpy())) for d in (a, b))
        ids = a["vec_id"].to_numpy()
        rows, found, scores = block_search(ids, q, b["vec_id"].to_numpy(), v, k)
        return pd.DataFrame({"query_row": a["row"].to_numpy()[rows], "query_id": ids[rows], "vec_id": found, "score": scores})

    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


OP3_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * v.x[i])) AS BIGINT) AS score
      FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
