import numpy as np
import pytest

from lexcurate.llm import whitening as W


def brute(x):
    """(n, sums, variances, components, trace) of distinct integer rows, in exact integers until the eigenvalues."""
    u = np.array(sorted({tuple(int(c) for c in r) for r in x}), dtype=object)
    n, s = len(u), u.sum(0)
    d = u * n - s
    cov = (d.T @ d).astype(np.float64) / float(n) ** 3
    e, v = np.linalg.eigh(cov)
    return n, s, e[::-1], v[:, ::-1], np.trace(cov)


def rows(df, k=W.COMPONENTS):
    return df.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()


def check(got, ids, x, k=W.COMPONENTS):
    n, s, e, v, trace = brute(x)
    kept = min(k, int((e > 1e-9 * e[0]).sum()))
    assert len(got) == len(ids) * kept
    deviation = {i: sum((n * int(c) - int(t)) ** 2 for c, t in zip(r, s)) for i, r in zip(ids, x)}
    table = {(r.vec_id, r.component): r for r in got}
    assert all(r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9 for r in got)
    for c in range(kept):
        want = (np.array(x, float) - (s / n).astype(float)) @ v[:, c] / np.sqrt(e[c])
        have = np.array([table[i, c + 1].whitened for i in ids])
        assert abs(table[ids[0], c + 1].explained - e[c] / trace) < 1e-12
        assert np.abs(have - want * np.sign(have @ want)).max() < 1e-7


def embedded(x):
    """Embeddings whose integers are x."""
    return ((np.asarray(x, float) - W.OFFSET) / W.SCALE).tolist()


@pytest.mark.parametrize("width", [5, 24])
def test_against_exact_covariance(spark, width):
    rng = np.random.default_rng(width)
    x = W.OFFSET + np.floor(rng.normal(size=(300, width)) * np.geomspace(4000, 3, width)).astype(int)
    x[40:160] = x[3]  # a third of all rows are one vector: it counts once
    df = spark.createDataFrame(list(zip(range(300), embedded(x))), "vec_id long, embedding array<double>").repartition(5)
    check(rows(W.whiten(df)), list(range(300)), x)


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(9)
    x = W.OFFSET + rng.integers(-900, 900, size=(80, 6))
    x[:, 4] = 2 * x[:, 0] - W.OFFSET - x[:, 1] + W.OFFSET  # a linear combination
    x[:, 5] = W.OFFSET
    df = spark.createDataFrame(list(zip(range(80), embedded(x))), "vec_id long, embedding array<double>")
    check(rows(W.whiten(df)), list(range(80)), x)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, [2.0, -1.0]), (None, [0.0, 3.0]), (3, None), (4, []), (5, [None, 1.0]),
               (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [3e38, 1.0, 0.0]), (10, [-3e38, 1.0, 5.0])]
    df = spark.createDataFrame([(*v, 7, 8) for v in vectors], "vec_id long, embedding array<double>, n int, component int")
    got = rows(W.whiten(df))
    flat = [r for r in got if r.n == 3 and r.vec_id in (1, 2, None) and r.deviation < 1 << 40]
    assert sorted((r.vec_id or 0, r.component) for r in flat) == sorted(2 * [(1, 1), (1, 2)] + [(2, 1), (2, 2), (0, 1), (0, 2)])
    assert {r.vec_id for r in got} == {1, 2, None, 8, 9, 10}  # the three wide ones are fitted apart
    assert all(np.isfinite(r.whitened) for r in got)
    assert max(r.deviation for r in got) == (1 << 63) - 1
    assert W.whiten(df.limit(0)).collect() == []
    assert W.whiten(df.where("vec_id = 1")).collect() == []  # one distinct vector: no variance


def test_triangular_solve_and_shift():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(50, 7)) * np.geomspace(1, 1e-9, 7)
    r = W.factor(a.T @ a, 50, True)
    assert np.allclose(np.tril(r, -1), 0) and np.allclose(W.solved(a, r) @ r, a, rtol=1e-12, atol=1e-24)


def test_query_reads_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    from lexcurate.llm.registry import QUERIES

    e = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.floor(64 * np.array([r.embedding for r in e], float)).astype(int) + W.OFFSET
    check(rows(QUERIES["op12_whitening"](spark, sf)), [r.vec_id for r in e], x)
