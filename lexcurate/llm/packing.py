"""Best-fit packing by exact-complement hashing over length counts.

Documents are encoded and cut into pieces of at most ``limit`` tokens. What
goes where depends on the pieces' lengths alone, so the packing is planned on
the histogram of lengths (at most ``limit`` numbers, whatever the corpus
holds): sums of one, two and three available lengths are indexed; from the
longest length down, combinations that fill a gap exactly are consumed as
often as the counts allow; best fit places what remains. A plan row gives a
pattern of lengths and how many sequences use it. Each piece then finds its
place from its rank among the pieces of its length: a rank within its task,
plus a running sum of the tasks' counts. No pieces are gathered anywhere.

Defined cases: null text is empty and gives the one closing id; repeated rows
and null ids are pieces of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexcurate.llm import common, words

LIMIT = 2048
END = words.to_bytes([0])
#: Words that a worker keeps: beside other operators, as in a pipeline, and alone.
CACHE_WORDS, CACHE_WORDS_ALONE = 50_000, 200_000


def pieces(docs: DataFrame, path: str | None = None, limit: int = LIMIT, outputs: bool = False, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Encoded pieces with ``task`` and ``nth``: the how-manieth piece of its length in its task."""
    path = path or words.tokenizer_path()
    common.configure(docs.sparkSession)

    def cut(batches):
        seen, task = [0] * (limit + 1), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.encode_bytes(path, text, cache_words) + END
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at:at + 4 * limit]
                    n = len(part) // 4
                    rows.append((doc_id, piece, at // 4, n, zlib.crc32(part), task, seen[n], part))
                    seen[n] += 1
            cols = list(zip(*rows)) or [()] * 8
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids")
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            k = len(names) if outputs else len(names) - 1
            yield pa.RecordBatch.from_arrays(arrays[:k], names=list(names[:k]))

    return (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))
            .mapInArrow(words.giving_back(cut), "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
                        + ", ids binary" * outputs))


class LengthIndex:
    """Which sums one, two or three available lengths make, as bit sets."""

    def __init__(self, counts: np.ndarray, limit: int):
        self.counts, self.limit, self.mask = counts, limit, (1 << (limit + 1)) - 1
        self.refresh()

    def refresh(self) -> None:
        lengths = np.flatnonzero(self.counts).tolist()
        self.one = sum(1 << n for n in lengths)
        self.two = self.three = 0
        for n in lengths:
            self.two |= (self.one << n) & self.mask
        for n in lengths:
            self.three |= (self.two << n) & self.mask

    def exact(self, gap: int, used: list[int]) -> list[int] | None:
        """Up to three available lengths that sum to ``gap``, besides those used."""
        free = self.counts.copy()
        np.subtract.at(free, used, 1)
        if gap and (self.one >> gap) & 1 and free[gap] > 0:
            return [gap]
        if (self.two >> gap) & 1 and (found := self.pair(gap, free)):
            return found
        if (self.three >> gap) & 1:
            for n in range(gap // 3, 0, -1):  # the least of the three, largest first: short ones stay for later
                if free[n] > 0 and (self.two >> (gap - n)) & 1:
                    free[n] -= 1
                    found = self.pair(gap - n, free)
                    free[n] += 1
                    if found:
                        return [*found, n]
        return None

    @staticmethod
    def pair(total: int, free: np.ndarray) -> list[int] | None:
        low = np.arange(1, total // 2 + 1)
        ok = (free[low] > 0) & (free[total - low] > 0)
        if total % 2 == 0 and len(low) and free[total // 2] < 2:
            ok[-1] = False
        good = np.flatnonzero(ok)
        return [total - int(low[good[-1]]), int(low[good[-1]])] if len(good) else None


def plan(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[list[int], int]]:
    """Patterns (lengths of one sequence, number of such sequences) that use up the histogram."""
    counts = np.zeros(limit + 1, np.int64)
    for n, c in histogram.items():
        counts[n] = c
    out: list[tuple[list[int], int]] = []
    index = LengthIndex(counts, limit)

    def consume(pattern: list[int]) -> None:
        kinds, each = np.unique(pattern, return_counts=True)
        times = int((counts[kinds] // each).min())
        out.append((pattern, times))
        counts[kinds] -= times * each
        if (counts[kinds] == 0).any():
            index.refresh()

    for n in range(limit, 0, -1):  # exact complements
        while counts[n] and (rest := [] if n == limit else index.exact(limit - n, [n])) is not None:
            consume([n, *rest])
    for n in range(limit, 0, -1):  # best fit of what remains
        while counts[n]:
            pattern, gap = [n], limit - n
            while gap:
                if rest := index.exact(gap, pattern):
                    pattern += rest
                    break
                free = counts.copy()
                np.subtract.at(free, pattern, 1)
                fits = np.flatnonzero(free[:gap + 1] > 0)
                if not len(fits):
                    break
                pattern.append(int(fits[-1]))
                gap -= pattern[-1]
            consume(pattern)
    return out


def slots(patterns: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """The plan by length: from which rank on which sequences and offsets serve it."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for n in sorted(set(pattern), reverse=True):
            each = pattern.count(n)
            rows.append((n, taken.get(n, 0), sequence, each, offset))
            taken[n] = taken.get(n, 0) + times * each
            offset += n * each
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "each", "offset"), table.T))


def pack(docs: DataFrame, path: str | None = None, limit: int = LIMIT, outputs: bool = False, cache_words: int = CACHE_WORDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (``outputs``: and ids).

    ``cache_words``: words whose ids a worker keeps, twice over (some 200 bytes each); more save time, and change nothing else."""
    spark = docs.sparkSession
    cut = common.table(pieces(docs, path, limit, outputs, cache_words), "pieces")
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = common.table(by_task.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    histogram = {r[0]: r[1] for r in by_task.groupBy("length").agg(F.sum("n")).collect()}  # at most ``limit`` rows
    table = spark.sparkContext.broadcast(slots(plan(histogram, limit)))  # at most a few rows a length
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * outputs

    def place(batches):
        t, shift = table.value, 1 << 46
        keys = t["length"] * shift + t["rank"]
        for batch in batches:
            n = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, n * shift + rank, "right") - 1
            k = rank - t["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(t["sequence"][at] + k // t["each"][at]),
                 pa.array(t["offset"][at] + k % t["each"][at] * n)], names=[*names, "sequence_id", "offset"])

    ranked = cut.join(by_task.select("length", "task", "earlier"), ["length", "task"])
    return (ranked.select(*names, (F.col("earlier") + F.col("nth")).alias("rank"))
            .mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long"
                        + ", ids binary" * outputs + ", sequence_id long, offset long"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.documents(spark, sf_dir), cache_words=CACHE_WORDS_ALONE)
