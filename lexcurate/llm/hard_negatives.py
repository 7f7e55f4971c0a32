"""Hard-negative mining with spanning-tree bounds over the anchors.

The anchors of a block are joined by a minimum spanning tree of their distances. If the
score of a candidate v at a parent anchor lies in [low, high], its score at a child
lies in [low - e |v|, high + e |v|], e being the edge's length (Cauchy-Schwarz). Scores
are exact at the root; going down the tree, only candidates whose interval reaches
a window of the child are scored exactly, the others keep their interval. A copy of
its parent (e = 0) is never scored again.

Two searches, both of a stated set (the anchors) against all rows, in blocks:
first each anchor's best rows of its own label (window: its k-th best so far and above),
then, for each of these positives, the best rows of other labels inside the positive's
window. Anchors that lie close together are dealt into one block: a
block is a range of random-projection signs, split further by a hash where many
anchors share them, so no block depends on how the vectors are spread.

Defined cases: rows with a null label or vec_id, a null or empty vector, or a null or non-finite
component take no part; only vectors of one width are compared; rows that repeat a vec_id
are rows of their own (an anchor's copy may be its positive, and repeated anchors are answered
each); ties go to the smaller vec_id; a positive with a negative score has no negatives;
products beyond 64 bits saturate; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexcurate.llm import common

EVERY, RELABELLED, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these shares of its positive's, in hundredths.
LOW, HIGH = 50, 95
ANCHOR_BLOCK, CANDIDATE_BLOCK, STRIDE = 1024, 16_384, 2048
#: Random signs that place an anchor, and the seed of their projections.
SIGNS, SEED = 12, 20_240_611
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(parent, edge length, levels): a minimum spanning tree of the rows, by Prim's method from row 0."""
    n = len(x)
    parent, edge, depth = np.full(n, -1), np.zeros(n), np.zeros(n, int)
    norms, near, link = (x * x).sum(1), np.full(n, np.inf), np.zeros(n, int)
    out = np.zeros(n, bool)
    at, order = 0, []
    for _ in range(n):
        order.append(at)
        out[at] = True
        squares = np.maximum(norms + norms[at] - 2 * (x @ x[at]), 0)
        closer = squares < near
        near[closer], link[closer] = squares[closer], at
        rest = np.where(out, np.inf, near)
        nxt = int(rest.argmin())
        if len(order) < n:
            parent[nxt], depth[nxt] = link[nxt], depth[link[nxt]] + 1
            edge[nxt] = np.sqrt(((x[nxt] - x[link[nxt]]) ** 2).sum())  # exactly 0 for a copy
            at = nxt
    return parent, edge, [np.flatnonzero(depth == d) for d in range(depth.max(initial=0) + 1)] if n else []


class Scores:
    """Exact integer products of anchors and candidates, in the narrowest type that holds them."""

    def __init__(self, anchors: np.ndarray, candidates: np.ndarray):
        most = np.sqrt((anchors ** 2).sum(1).max(initial=0)) * np.sqrt((candidates ** 2).sum(1).max(initial=0))
        self.wide = not most < 2.0 ** 52
        kind = np.float32 if most < 2.0 ** 23 else np.float64  # partial sums stay below the product of norms
        self.a, self.v = (anchors, candidates) if self.wide else (anchors.astype(kind), candidates.astype(kind))

    def table(self, some: np.ndarray, block: slice) -> np.ndarray:
        """Scores of anchors ``some`` with a run of candidates, one row an anchor."""
        if not self.wide:
            return (self.a[some] @ self.v[block].T).astype(np.float64)
        return self.exact(self.a[some], self.v[block])

    def pairs(self, rows: np.ndarray, found: np.ndarray) -> np.ndarray:
        if not self.wide:
            return np.einsum("ij,ij->i", self.a[rows], self.v[found]).astype(np.float64)
        return np.array([self.exact(self.a[r][None], self.v[c][None])[0, 0] for r, c in zip(rows, found)], object)

    @staticmethod
    def exact(a: np.ndarray, v: np.ndarray) -> np.ndarray:
        whole = np.frompyfunc(int, 1, 1)
        product = whole(a).dot(whole(v).T)
        return np.minimum(np.maximum(product, LEAST), MOST)


def reached(low: np.ndarray, high: np.ndarray, floor: np.ndarray, ceiling: np.ndarray) -> np.ndarray:
    """Which intervals meet their anchor's window."""
    return (high >= floor[:, None]) & (low <= ceiling[:, None])


class Search:
    """Candidates inside the windows of a block's anchors, stride by stride."""

    def __init__(self, anchors: np.ndarray, candidates: np.ndarray):
        self.scores, self.anchors = Scores(anchors, candidates), anchors
        self.norms = np.sqrt((candidates ** 2).sum(1))
        self.parent, self.edge, self.levels = spanning_tree(anchors)
        self.scored = 0

    def stride(self, block: slice, floor: np.ndarray, ceiling: np.ndarray, allowed: np.ndarray):
        """(anchor row, candidate, score) of the allowed pairs of a run of candidates inside [floor, ceiling]."""
        if self.scores.wide:  # bounds in doubles can't tell such scores apart
            score = self.scores.table(np.arange(len(self.anchors)), block)
            rows, cols = np.nonzero(allowed)
            return rows, cols + block.start, score[rows, cols].astype(np.int64)
        norms = self.norms[block]
        low = np.empty((len(self.anchors), len(norms)))
        high = np.empty_like(low)
        for depth, level in enumerate(self.levels):
            if depth == 0:
                low[level] = high[level] = self.scores.table(level, block)
                self.scored += len(level) * len(norms)
                continue
            up, reach = self.parent[level], self.edge[level][:, None] * norms * (1 + 1e-9)
            reach += (self.edge[level] > 0)[:, None] * 1e-6
            lo, hi = low[up] - reach, high[up] + reach
            open_ = reached(lo, hi, floor[level], ceiling[level]) & allowed[level] & (lo < hi)
            share = open_.mean(1)
            dense = np.flatnonzero(share > 1 / 16)  # most pairs of an anchor are open: one product for all of them
            if len(dense):
                lo[dense] = hi[dense] = self.scores.table(level[dense], block)
                open_[dense] = False
                self.scored += len(dense) * len(norms)
            rows, cols = np.nonzero(open_)
            if len(rows):
                lo[rows, cols] = hi[rows, cols] = self.scores.pairs(level[rows], cols + block.start)
                self.scored += len(rows)
            low[level], high[level] = lo, hi
        inside = allowed & (low == high) & (low >= floor[:, None]) & (low <= ceiling[:, None])
        rows, cols = np.nonzero(inside)
        return rows, cols + block.start, low[rows, cols].astype(np.int64)


def best(rows: np.ndarray, found: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row: higher scores first, ties to the smaller id, then to the earlier candidate."""
    top = np.lexsort((found, ids[found], ~scores, rows))
    place = np.arange(len(top)) - np.searchsorted(rows[top], rows[top], "left")
    return top[place < k]


def strides(n: int, allowed_of):
    """Runs of candidates, a short one first to raise the floors, each with the pairs allowed in it."""
    ends = [0, *range(min(n, STRIDE // 16), n, STRIDE), n]
    for i, j in zip(ends, ends[1:]):
        if i < j:
            yield slice(i, j), allowed_of(slice(i, j))


def best_positives(a: dict, v: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor row, candidate, score): each anchor's k best other rows of the block."""
    search = Search(a["x"], v["x"])
    n = len(a["x"])
    rows, found, scores = np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)
    floor, ceiling = np.full(n, -np.inf), np.full(n, np.inf)
    for block, allowed in strides(len(v["x"]), lambda b: a["row"][:, None] != v["row"][b][None, :]):
        r, f, s = search.stride(block, floor, ceiling, allowed)
        rows, found, scores = np.concatenate([rows, r]), np.concatenate([found, f]), np.concatenate([scores, s])
        keep = best(rows, found, scores, v["id"], k)
        rows, found, scores = rows[keep], found[keep], scores[keep]
        full, count = np.unique(rows, return_counts=True)
        last = np.searchsorted(rows, full, "right") - 1
        floor[full[count == k]] = scores[last[count == k]]
    return rows, found, scores


def best_negatives(a: dict, v: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, candidate, score): for each anchor and positive, the k best rows of another label in the positive's window.

    ``a["positive"]``: one array of positive scores an anchor; pairs are numbered through, anchor by anchor."""
    search = Search(a["x"], v["x"])
    n_of = np.array([len(p) for p in a["positive"]], int)
    owner = np.repeat(np.arange(len(n_of)), n_of)
    positive = [int(s) for p in a["positive"] for s in p]
    # the window in whole scores: ceil(LOW p / 100) .. floor(HIGH p / 100); the floor becomes the pair's k-th best
    floor = np.array([-(-LOW * p // 100) for p in positive], np.int64)
    high = np.array([HIGH * p // 100 for p in positive], np.int64)
    pairs, found, scores = np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)

    def outer(values: np.ndarray, start: float, least: bool) -> np.ndarray:
        """An anchor's smallest floor, or greatest ceiling."""
        out = np.full(len(n_of), start)
        (np.minimum if least else np.maximum).at(out, owner, values.astype(float))
        return out

    ceiling = outer(high, -np.inf, False)
    for block, allowed in strides(len(v["x"]), lambda b: a["label"][:, None] != v["label"][b][None, :]):
        r, f, s = search.stride(block, outer(floor, np.inf, True), ceiling, allowed)
        # each hit, once for every pair of its anchor whose window holds it
        times = n_of[r]
        pair = np.repeat(np.concatenate([[0], np.cumsum(n_of)])[r], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        f, s = np.repeat(f, times), np.repeat(s, times)
        inside = (s >= floor[pair]) & (s <= high[pair])
        pairs, found, scores = np.concatenate([pairs, pair[inside]]), np.concatenate([found, f[inside]]), np.concatenate([scores, s[inside]])
        keep = best(pairs, found, scores, v["id"], k)
        pairs, found, scores = pairs[keep], found[keep], scores[keep]
        full, count = np.unique(pairs, return_counts=True)
        last = np.searchsorted(pairs, full, "right") - 1
        floor[full[count == k]] = scores[last[count == k]]
    return pairs, found, scores


def _block(rows: pd.DataFrame) -> dict:
    """A group's rows as arrays, vectors as integers held in doubles."""
    out = {"x": np.floor(256.0 * np.stack(rows["x"].to_numpy())), "row": rows["row"].to_numpy(), "id": rows["vec_id"].to_numpy(),
           "label": rows["label"].to_numpy()}
    if "positive_score" in rows:
        out["positive"] = [np.asarray(p) for p in rows["positive_score"]]
    return out


def sound(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, x) of the rows that take part."""
    x = F.col("embedding")
    whole = F.forall(x, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < float("inf")) & ~F.isnan(e.cast("double")))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(x) > 0) & whole)
            .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                    F.col("label").cast("long").alias("label"), x.cast("array<double>").alias("x")))


def place() -> Column:
    """Where a vector lies: the signs of some random projections, then a hash of the row."""
    def bit(seed: int) -> Column:
        # a random sign for each dimension, drawn by hash so that any width has them
        signed = F.transform("x", lambda e, i: F.when(F.xxhash64(i, F.lit(seed)) % 2 == 0, e).otherwise(-e))
        return F.when(F.aggregate(signed, F.lit(0.0), lambda t, e: t + e) > 0, 1).otherwise(0)

    bits = [bit(SEED + i) for i in range(SIGNS)]
    code = sum((b.cast("long") * (1 << i) for i, b in enumerate(bits)), F.lit(0).cast("long"))
    return code * F.lit(1 << 40) + F.pmod(F.xxhash64("row"), F.lit(1 << 40))


def borders(frame: DataFrame, place: str, size: int) -> list[int]:
    """Borders that deal the rows by ``place`` into blocks of about ``size``: all that reaches the driver."""
    blocks = -(-frame.count() // size)
    return list(frame.select(F.percentile_approx(place, [i / blocks for i in range(1, blocks)], 20 * blocks)).first()[0]) if blocks > 1 else []


def block_number(place: str, borders: list[int]) -> Column:
    return F.expr("aggregate(array(" + ",".join(f"{b}L" for b in borders) + f"), 0L, (n, b) -> n + if({place} > b, 1L, 0L))") if borders \
        else F.lit(0).cast("long")


def spread(frame: DataFrame, name: str, first: Column, last: Column) -> DataFrame:
    """Every row once for each of a range of blocks of the other side."""
    return frame.withColumn(name, F.explode(F.sequence(first.cast("long"), last.cast("long"))))


def positives(rows: DataFrame, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """(row, positive_id, positive_row, positive_score, place): the k best other rows of each anchor's label and width."""
    key = ["label", "width"]
    # anchors in the order of label, then place: a hot label has many blocks, and a rare one a part of one
    first = F.pmod(F.xxhash64(*key), F.lit(1 << 20)) * F.lit(1 << 32)
    anchors = anchors.withColumn("by_label", first + F.shiftright("place", 20))
    edges = borders(anchors, "by_label", ANCHOR_BLOCK)
    labels = rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / CANDIDATE_BLOCK).alias("v_blocks"))
    labels = labels.withColumn("low", first).withColumn("high", first + F.lit((1 << 32) - 1)).select(
        *key, "v_blocks", block_number("low", edges).alias("a_first"), block_number("high", edges).alias("a_last"))
    labels = common.sized(common.table(labels, "label-blocks"))
    left = spread(anchors.withColumn("a_block", block_number("by_label", edges)).join(labels, key), "v_block", F.lit(0), F.col("v_blocks") - 1)
    right = spread(rows.join(labels, key).withColumn("v_block", F.pmod(F.col("row"), F.col("v_blocks"))), "a_block", F.col("a_first"), F.col("a_last"))
    left, right = (side.select(*key, "a_block", "v_block", "row", "vec_id", "x") for side in (left, right))
    names = [*key, "a_block", "v_block"]

    def search(keys, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("row", "positive_row", "positive_id", "positive_score")})
        left, right = _block(a), _block(b)
        r, f, s = best_positives(left, right, k)
        return pd.DataFrame({"row": left["row"][r], "positive_row": right["row"][f], "positive_id": right["id"][f],
                             "positive_score": s.astype(np.int64)})

    near = left.groupBy(*names).cogroup(right.groupBy(*names)).applyInPandas(
        search, "row long, positive_row long, positive_id long, positive_score long")
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    return near.withColumn("place_of", F.row_number().over(order)).where(F.col("place_of") <= k)


def mine(vectors: DataFrame, is_anchor: Column, k_positive: int = POSITIVES, k_negative: int = NEGATIVES) -> DataFrame:
    """``vectors``: (vec_id, embedding, label); ``is_anchor``: a condition on vec_id. One row an anchor, positive and negative."""
    common.configure(vectors.sparkSession)
    rows = common.table(sound(vectors).withColumn("width", F.size("x")), "vectors")
    anchors = common.table(rows.where(is_anchor).withColumn("place", place()), "anchors")
    found = common.table(positives(rows, anchors, k_positive), "positives")
    listed = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place_of", "positive_id", "positive_score"))).alias("p"))  # k at most
    anchors = anchors.join(listed, "row").select("row", "vec_id", "label", "width", "x", "place", "p.positive_id", "p.positive_score")
    edges, v_blocks = borders(anchors, "place", ANCHOR_BLOCK), max(1, -(-rows.count() // CANDIDATE_BLOCK))
    left = spread(anchors.withColumn("a_block", block_number("place", edges)), "v_block", F.lit(0), F.lit(v_blocks - 1))
    right = spread(rows.withColumn("v_block", F.pmod(F.col("row"), F.lit(v_blocks))), "a_block", F.lit(0), F.lit(len(edges)))
    names = ["width", "a_block", "v_block"]

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("row", "anchor_id", "place_of", "positive_id", "positive_score",
                                                                     "negative_row", "negative_id", "negative_score")})
        left, right = _block(a), _block(b)
        pairs, f, s = best_negatives(left, right, k_negative)
        n_of = np.array([len(p) for p in left["positive"]], int)
        owner = np.repeat(np.arange(len(n_of)), n_of)
        spot = np.concatenate([np.arange(n) for n in n_of]) if len(n_of) else np.zeros(0, int)
        ids = np.concatenate([np.asarray(p) for p in a["positive_id"]])
        scores = np.concatenate(left["positive"])
        return pd.DataFrame({"row": left["row"][owner[pairs]], "anchor_id": left["id"][owner[pairs]], "place_of": spot[pairs],
                             "positive_id": ids[pairs], "positive_score": scores[pairs], "negative_row": right["row"][f],
                             "negative_id": right["id"][f], "negative_score": s.astype(np.int64)})

    near = (left.drop("place").groupBy(*names).cogroup(right.groupBy(*names))
            .applyInPandas(search, "row long, anchor_id long, place_of long, positive_id long, positive_score long, "
                                   "negative_row long, negative_id long, negative_score long"))
    order = Window.partitionBy("row", "place_of").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k_negative)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % RELABELLED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mine(v.withColumn("label", label), F.col("vec_id") % EVERY == 0)


OP11_SQL = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % {RELABELLED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, v.r, v.vec_id, a.label = v.label AS same,
             CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * v.x[i])) AS BIGINT) AS score
      FROM v AS a JOIN v ON a.vec_id % {EVERY} = 0 AND a.r <> v.r AND len(a.x) = len(v.x)),
p AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, r) AS place FROM s WHERE same),
n AS (SELECT p.a, p.anchor_id, p.place, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.a, p.place ORDER BY s.score DESC, s.vec_id, s.r) AS INTEGER) AS rank
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND p.place <= {POSITIVES}
        AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
