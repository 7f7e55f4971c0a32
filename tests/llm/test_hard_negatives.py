import numpy as np
import pytest

from lexcurate.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=50, k=5, m=3):
    """(anchor, positive, rank, negative, positive score, negative score) by all pairs, in Python integers."""
    x = [[int(np.floor(256 * float(c))) for c in e] for _, e, _ in rows]
    cut = lambda s: min(max(s, H.LEAST), H.MOST)
    out = []
    for i, (a, _, la) in enumerate(rows):
        if a % every:
            continue
        scores = [(-cut(sum(p * q for p, q in zip(x[i], x[j]))), rows[j][0], j) for j in range(len(rows)) if j != i and len(x[i]) == len(x[j])]
        same = sorted(s for s in scores if rows[s[2]][2] == la)[:k]
        other = sorted(s for s in scores if rows[s[2]][2] != la)
        for p, pid, _ in same:
            inside = [s for s in other if 50 * -p <= 100 * -s[0] <= 95 * -p][:m]
            out += [(a, pid, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, extra=()):
    df = spark.createDataFrame([*rows, *extra], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in H.mine(df, H.F.col("vec_id") % 50 == 0).collect())


def some(rng, n, width, scale=0.2):
    centres = rng.normal(size=(12, width)) * scale
    return [(int(i), (centres[rng.integers(12)] + rng.normal(size=width) * scale * rng.choice([0, 0.01, 0.4])).tolist(), int(rng.integers(3)))
            for i in range(n)]


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(H, "ANCHOR_BLOCK", 3)
    monkeypatch.setattr(H, "CANDIDATE_BLOCK", 90)
    monkeypatch.setattr(H, "STRIDE", 32)


@pytest.mark.parametrize("width,scale", [(16, 0.2), (2, 3.0), (8, 1e9)])
def test_against_all_pairs(spark, small_blocks, width, scale):
    rows = some(np.random.default_rng(width), 520, width, scale)
    for i in (50, 100, 150, 151, 152, 200):  # anchors that are copies, and rows that repeat an id
        rows[i] = (i, rows[0][1], 1)
    rows += [(100, rows[0][1], 1), (100, rows[3][1], 2), (150, rows[7][1], 1)]
    assert mined(spark, rows) == brute(rows)


def test_hot_label(spark, small_blocks):
    rows = [(i, e, 0 if i % 3 else label) for i, e, label in some(np.random.default_rng(5), 700, 6)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.8, 3.0], 1), (3, [0.7, -3.0], 1), (4, [0.96, 0.0], 1), (5, [0.5, 1.0], 2),
            (6, [0.4, 0.0], 2), (50, [0.0, -1.0], 4), (51, [0.0, 0.5], 4), (100, [1.0, 2.0, 3.0], 0), (101, [1.0, 2.0, 3.0], 0), (102, [1.0, 2.0, 1.0], 1)]
    odd = [(150, None, 1), (7, [], 1), (8, [None, 1.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (200, [1.0, 0.0], None), (None, [0.9, 0.0], 1)]
    got = mined(spark, rows, odd)
    assert got == brute(rows)
    assert [g[:4] for g in got if g[0] == 0] == [(0, 1, 1, 2), (0, 1, 2, 3), (0, 1, 3, 5)]
    assert not [g for g in got if g[0] == 50]  # its positive's score is negative: the window is empty
    df = spark.createDataFrame(rows, SCHEMA)
    assert H.mine(df.limit(0), H.F.col("vec_id") % 50 == 0).collect() == []
    assert H.mine(df, H.F.col("vec_id") < 0).collect() == []
    clashing = df.selectExpr("*", "1 row", "2 place", "3 score", "4 a_block", "5 width", "6 x")
    assert sorted(tuple(r) for r in H.mine(clashing, H.F.col("vec_id") % 50 == 0).collect()) == got


def test_bounds_spare_scores():
    rng = np.random.default_rng(8)
    anchors = np.floor(256 * (rng.normal(size=(1, 32)) + 0.001 * rng.normal(size=(60, 32))))
    candidates = np.floor(256 * rng.normal(size=(3000, 32)))
    anchors[30:] = anchors[0]
    parent, edge, levels = H.spanning_tree(anchors)
    assert sum(map(len, levels)) == 60 and (edge[1:] >= 0).all() and all(parent[c] >= 0 for level in levels[1:] for c in level)
    search = H.Search(anchors, candidates)
    exact = anchors @ candidates.T
    floor = np.sort(exact, 1)[:, -20]
    rows, found, scores = search.stride(slice(0, 3000), floor, np.full(60, np.inf), np.ones(exact.shape, bool))
    assert sorted(zip(rows, found)) == sorted(zip(*np.nonzero(exact >= floor[:, None])))
    assert (scores == exact[rows, found]).all()
    assert search.scored < 0.2 * exact.size
