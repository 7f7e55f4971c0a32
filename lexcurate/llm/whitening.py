"""Embedding whitening by shifted CholeskyQR.

The centred rows A (one a distinct vector) are orthogonalised in distributed passes. A pass
solves A = Q R against the factors found so far, row by row inside the tasks, and
sums the Gram matrix of Q; its Cholesky factor is the next R. The first Gram
matrix is shifted, so that the factor exists however ill-conditioned A is, and later
passes take the shift's effect out again. When Q's Gram matrix G is settled, sqrt(G) R of the
composed factors has A's singular values and right singular vectors; its SVD gives the
components. Only d x d matrices reach the driver, d being the width of a vector.

Entries are integers x = floor(64 c) + 1000000, centred exactly: n x - S, n vectors of sum S.

Defined cases: rows whose vector is null, empty or holds a null or non-finite entry
are dropped; repeated rows are whitened each, but fitted once; vectors of different width are
fitted apart, each width with its own n, components and identity_error; a row with a null
vec_id is whitened like any other; entries beyond 2^62 and deviations beyond 64 bits
saturate; a component with no more than 1e-26 of the largest variance can't be told
from rounding and is left out, so a single vector has no rows; an empty table gives
none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.llm import common

COMPONENTS, SCALE, OFFSET, LARGEST = 16, 64.0, 1_000_000, float(1 << 62)
#: Q counts as orthonormal when no entry of its Gram matrix is off by more; passes at most.
SETTLED, PASSES = 1e-12, 8
#: Least variance of a component, against the largest; vectors handled at once.
LEAST_SHARE, ROWS = 1e-26, 4096


@dataclass
class Fit:
    """What is known of the vectors of one width."""

    n: int
    sums: np.ndarray  # exact integers
    factors: list[np.ndarray] = field(default_factory=list)
    components: np.ndarray | None = None  # one a column
    variances: np.ndarray | None = None
    total: float = 0.0
    identity_error: float = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly; Python integers where 64 bits may not do."""
        wide = self.n * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))), 1)) >= 1 << 61
        return x.astype(object) * self.n - self.sums if wide else x * self.n - self.sums.astype(np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        """The rows of Q: the centred rows, solved against every factor so far."""
        q = self.centred(x)
        for r in self.factors:
            q = solved(q, r)
        return q

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.variances)


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q R = A, R upper triangular: one column after the other."""
    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper Cholesky factor; shifted in the first pass and where the matrix is singular to working precision."""
    d, unit = gram.shape[0], np.finfo(np.float64).eps / 2
    shift = 11 * (n * d + d * (d + 1)) * unit * max(np.linalg.norm(gram, 2), np.finfo(np.float64).tiny)
    if not first:
        try:
            lower = np.linalg.cholesky(gram)
            if lower.diagonal().min() > 1e-6:
                return lower.T
        except np.linalg.LinAlgError:
            pass
        shift = min(shift, 1e-10)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 16


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part, x as array<bigint>."""
    e = F.col("embedding")
    sound = F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    scaled = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    return vectors.where((F.size(e) > 0) & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(e, lambda c: F.floor(scaled(c)) + F.lit(OFFSET)).alias("x"))


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each width, a bounded number of rows at once."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    widths = np.diff(ends)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        for i in range(0, len(rows), ROWS):
            some = rows[i:i + ROWS]
            yield some, values[ends[some][:, None] + np.arange(width)]


def _list_array(batch: pa.RecordBatch) -> pa.ListArray:
    x = batch.column("x")
    return x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x


def first_sums(fit_list: DataFrame) -> dict[int, Fit]:
    """n and the exact sums, by width."""
    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in matrices(_list_array(batch)):
                wide = int(max(abs(int(x.max())), abs(int(x.min())))) * len(x) >= 1 << 62
                sums = (x.astype(object) if wide else x).sum(0).astype(object)
                n, before = held.get(x.shape[1], (0, 0))
                held[x.shape[1]] = [n + len(x), before + sums]
        for width, (n, sums) in held.items():
            yield pa.RecordBatch.from_pydict({"width": pa.array([width] * (width + 1), pa.int32()),
                                              "cell": pa.array(range(-1, width), pa.int32()),
                                              "value": pa.array([str(v) for v in (n, *sums)])})

    rows = (fit_list.mapInArrow(add, "width int, cell int, value string").groupBy("width", "cell")
            .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    fits: dict[int, Fit] = {}
    for width in {r.width for r in rows}:
        cells = {r.cell: int(r.value) for r in rows if r.width == width}
        fits[width] = Fit(cells[-1], np.array([cells[i] for i in range(width)], object))
    return fits


def gram(fit_list: DataFrame, rows_of: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Gram matrix of the rows ``rows_of(width, x)``, by width of x: summed in the tasks, then cell by cell."""
    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in matrices(_list_array(batch)):
                q = rows_of(x.shape[1], x)
                held[x.shape[1]] = held.get(x.shape[1], 0) + q.T @ q
        for width, g in held.items():
            upper = np.triu_indices(len(g))
            yield pa.RecordBatch.from_pydict({"width": pa.array(np.full(len(upper[0]), width), pa.int32()),
                                              "cell": pa.array(upper[0] * len(g) + upper[1], pa.int64()), "value": g[upper]})

    rows = (fit_list.mapInArrow(add, "width int, cell long, value double").groupBy("width", "cell")
            .agg(F.sum("value").alias("value")).collect())
    grams = {}
    for width in {r.width for r in rows}:
        cells = sorted((r.cell, r.value) for r in rows if r.width == width)
        d = int(round((np.sqrt(8 * len(cells) + 1) - 1) / 2))
        g = np.zeros((d, d))
        g[np.triu_indices(d)] = [v for _, v in cells]
        grams[width] = np.triu(g) + np.triu(g, 1).T
    return grams


def settled(g: np.ndarray) -> bool:
    """Are Q's columns orthonormal, but for columns that vanish?"""
    off = np.abs(g - np.diag(g.diagonal())).max(initial=0)
    diagonal = g.diagonal()
    return off <= SETTLED and bool(np.all((np.abs(diagonal - 1) <= SETTLED) | (diagonal <= SETTLED)))


def fitted(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Sums, factors, components and variances of ``fit_list`` (x: distinct vectors), by width."""
    fits = first_sums(fit_list)
    todo, last = set(fits), {}
    for k in range(PASSES):
        doing = {w: fits[w] for w in todo}
        some = fit_list.where(F.size("x").isin(sorted(todo))) if todo != set(fits) else fit_list
        grams = gram(some, lambda width, x: doing[width].orthogonal(x))
        for width, g in grams.items():
            last[width] = g
            if k and (settled(g) or k + 1 == PASSES):
                todo = todo - {width}
            else:
                fits[width].factors.append(factor(g, fits[width].n, k == 0))
        if not todo:
            break
    for width, fit in fits.items():
        r = np.eye(width)
        for one in fit.factors:
            r = one @ r
        size, basis = np.linalg.eigh(last[width])
        root = basis * np.sqrt(np.where(size > 1e-9, size, 0)) @ basis.T
        singular, right = np.linalg.svd(root @ r)[1:]
        variances = singular ** 2 / fit.n
        fit.total = float(variances.sum())
        kept = int((variances[:components] > LEAST_SHARE * variances[0]).sum())
        fit.components, fit.variances = right[:kept].T, variances[:kept]
    whole = {w: f for w, f in fits.items() if len(f.variances)}
    if whole:
        covariances = gram(fit_list.where(F.size("x").isin(sorted(whole))), lambda width, x: whole[width].whitened(x))
        for width, g in covariances.items():
            fits[width].identity_error = float(np.abs(g / fits[width].n - np.eye(len(g))).max())
    return fits


def squares(deviations: np.ndarray) -> np.ndarray:
    """Sum of squares a row, exact, saturating at 64 bits."""
    if deviations.dtype != object and (np.abs(deviations).max(initial=0).astype(float) ** 2) * deviations.shape[1] < 2.0 ** 62:
        return (deviations * deviations).sum(1)
    wide = deviations.astype(object)
    return np.array([min(int(v), (1 << 63) - 1) for v in (wide * wide).sum(1)], np.int64)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vectors``: (vec_id, embedding). One row a vector and component."""
    common.configure(vectors.sparkSession, batch_rows=ROWS)
    rows = integers(vectors)
    fits = fitted(common.table(rows.select("x").distinct(), "distinct"), components)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")

    def project(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for some, x in matrices(_list_array(batch)):
                fit = fits[x.shape[1]]
                k = len(fit.variances)
                if not k:
                    continue
                w, deviation = fit.whitened(x), squares(fit.deviations(x))
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(some, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(some))),
                    pa.array(np.full(len(some) * k, fit.n, np.int64)), pa.array(np.repeat(deviation, k)), pa.array(w.ravel()),
                    pa.array(np.tile(fit.variances / fit.total, len(some))), pa.array(np.full(len(some) * k, fit.identity_error))],
                    names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(project, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
