"""Quality classifier: naive Bayes support vectors.

Features are binary indicators of n-grams: words and word pairs, the shapes of
words and pairs of shapes (letters folded to their case, other characters
kept), and runs of one word; all hashed. Indicators are scaled by the log
ratio of the classes' smoothed counts, rows to unit length, and a linear
hinge-loss model is fitted by dual coordinate descent. A logistic curve over
margins of rows left out of a half-sample fit turns margins into scores.

The model is fitted on at most SAMPLE_ROWS labelled documents, those with the
smallest hash of their id (a documented bound; the fit is one task's work), one
row each: of a repeated id the text with the smallest hash.
Every row is scored from its whole text.

Defined cases: null text is empty, and a text without words gets the score of
the bias alone; labels that are null are ignored, and a document with several
labels has their majority (ties: 1); without labels of both classes the score is
the share of label 1, or 0.5 without any; repeated rows and null ids are
scored row by row (null ids count as not held out and never train); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.llm import common, words

SAMPLE_ROWS, FEATURES, THRESHOLD = 8192, 1 << 18, 0.3
COST, EPOCHS, SMOOTHING = 1.0, 8, 1.0
_U = np.uint64
_STEP, _LETTERS = _U(0x9E3779B97F4A7C15), re.compile(r"[^\W\d_]+")


def _shape(word: str) -> str:
    """Letters folded to x, X or Xx, digits to 9; other characters, at most two of a run, stay."""
    fold = _LETTERS.sub(lambda m: "x" if m[0].islower() else "X" if m[0].isupper() and len(m[0]) > 1 else "Xx", word[:32])
    return re.sub(r"(.)\1\1+", r"\1\1", re.sub(r"\d+", "9", fold))


@words.worker_cache("quality")
def _hashes() -> words.Bounded:
    """A word's hash, its low 20 bits replaced by those of its shape's hash."""
    return words.Bounded(lambda w: xxhash.xxh3_64_intdigest(w) >> 20 << 20 | xxhash.xxh3_64_intdigest(_shape(w)) & 0xFFFFF, words.CACHE_WORDS // 2)


def features(text: str, size: int = FEATURES) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    split = text.split()
    h = np.fromiter(map(_hashes().__getitem__, split), np.uint64, len(split))
    shape = (h & _U(0xFFFFF)) | _U(1 << 40)
    same = (h[1:] == h[:-1]).astype(np.uint64)
    runs = same[1:] & same[:-1]
    top = _U(64 - int(size).bit_length() + 1)
    parts = [h, h[:-1] * _STEP + h[1:], shape, shape[:-1] * _STEP + shape[1:], same + _U(11), runs + _U(21)]
    return np.unique(np.concatenate([(p * _STEP ^ (p * _STEP >> _U(29))) * _STEP >> top for p in parts])).astype(np.int32)


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: float = COST,
            epochs: int = EPOCHS) -> np.ndarray:
    """Dual coordinate descent for the hinge loss; the weights, with the bias last. Rows have unit length."""
    w, alpha, rng = np.zeros(size + 1), np.zeros(len(rows)), np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i], values[i]
            gradient = y[i] * (w[at] @ x + w[size]) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), cost)  # squared length 1, and 1 for the bias
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * x
                w[size] += step
                alpha[i] = new
    return w


def log_ratios(rows: list[np.ndarray], y: np.ndarray, size: int, smoothing: float = SMOOTHING) -> np.ndarray:
    good, bad = (np.bincount(np.concatenate([r for r, k in zip(rows, y) if k == sign] or [np.zeros(0, np.int32)]), minlength=size)
                 + smoothing for sign in (1, -1))
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def scaled(row: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    x = ratio[row]
    length = np.sqrt(x @ x)
    return x / length if length else x


def logistic(margins: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and intercept of P(label 1 | margin), by damped Newton steps on smoothed targets."""
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x, beta = np.stack([margins, np.ones(len(margins))], 1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * beta), -2, 2)
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], y: np.ndarray, size: int = FEATURES) -> dict:
    """y: 1 or -1. The model: log ratios, weights, and the logistic curve."""
    if not len(y) or abs(y.sum()) == len(y):
        share = float((y > 0).mean()) if len(y) else 0.5
        return {"ratio": np.zeros(size), "w": np.zeros(size + 1), "curve": (0.0, 0.0), "constant": share}

    def model(some):
        part, sign = [rows[i] for i in some], y[some]
        ratio = log_ratios(part, sign, size).astype(np.float32)  # half the memory of the scaled rows
        return ratio, descend(part, [scaled(r, ratio) for r in part], sign, size)

    half = np.random.default_rng(1).random(len(y)) < 0.5
    margins = np.zeros(len(y))
    for mine in (half, ~half):
        ratio, w = model(np.flatnonzero(mine))
        for i in np.flatnonzero(~mine):
            margins[i] = w[rows[i]] @ scaled(rows[i], ratio) + w[size]
    ratio, w = model(np.arange(len(y)))
    return {"ratio": ratio, "w": w, "curve": logistic(margins, y), "constant": None}


def train(docs: DataFrame, labels: DataFrame, most_rows: int = SAMPLE_ROWS) -> dict:
    """Fit on at most ``most_rows`` of the labelled documents that aren't held out."""
    def gather(batches):
        rows, y = [], []
        for batch in batches:
            rows += [features(t) for t in batch.column(1).to_pylist()]
            y += batch.column(0).to_pylist()
        got = fit(rows, np.where(np.array(y, np.int64) > 0, 1, -1) if y else np.zeros(0))
        yield pa.RecordBatch.from_pydict({
            "ratio": [got["ratio"].astype("<f4").tobytes()], "w": [got["w"].astype("<f4").tobytes()],
            "curve": pa.array([list(got["curve"])], pa.list_(pa.float64())), "constant": pa.array([got["constant"]], pa.float64())})

    truth = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out("doc_id")) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    present = truth.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    some = common.table(present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows), "labels")
    # at most most_rows narrow rows are broadcast; a task keeps one text an id before the shuffle
    rows = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "label") \
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("label", "t.text")
    row = rows.repartition(1).mapInArrow(words.giving_back(gather), "ratio binary, w binary, curve array<double>, constant double").first()
    if row is None:
        return fit([], np.zeros(0))
    return {"ratio": np.frombuffer(row.ratio, "<f4"), "w": np.frombuffer(row.w, "<f4"), "curve": tuple(row.curve), "constant": row.constant}


def held_out(doc_id: str):
    """Rows kept out of every fit: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scores(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, row_key (where ``docs`` is keyed)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 x 4 bytes a feature, whatever the corpus
    key = [F.col(common.KEY).alias("row_key")] if common.KEY in docs.columns else []

    def rate(batches):
        m = shared.value
        ratio, w, (slope, shift) = m["ratio"], m["w"], m["curve"]
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                at = features(text)
                margin = float(w[at] @ scaled(at, ratio) + w[-1])
                out.append(m["constant"] if m["constant"] is not None
                           else 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30))))
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.float64())], names=[*keep, "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *key, F.coalesce("text", F.lit("")).alias("text"))
    out = rows.mapInArrow(words.giving_back(rate), "doc_id long, " + "row_key long, " * bool(key) + "score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), *["row_key"] * bool(key))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scores(docs, train(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    docs = common.keyed(docs)
    return common.without(docs, classify(docs, labels).where("predicted = 0"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
