import numpy as np

from lexcurate.llm import topk


def brute(ids, x, k=5):
    y = [[int(np.floor(256 * float(c))) for c in r] for r in x]
    out = set()
    for i, d in enumerate(ids):
        if d % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(y[i], y[j])), ids[j]) for j in range(len(ids)) if ids[j] != d)[:k]
            out |= {(d, r + 1, v, -s) for r, (s, v) in enumerate(best)}
    return out


def test_blocks_prune_without_loss():
    rng = np.random.default_rng(1)
    for scale, dim in ((0.1, 64), (3, 7), (1, 1), (1e9, 8)):
        v = np.floor(256 * scale * (rng.normal(size=(700, dim)) + rng.normal(size=(700, 1))))
        v[10:20] = v[5]
        q = v[::7]
        r, f, s = topk.block_search(np.arange(0, 700, 7), q, np.arange(700), v, 5, stride=64)
        got = {}
        for a, b, c in zip(r, f, s):
            got.setdefault(a, []).append((-int(c), int(b)))
        for i in range(len(q)):
            want = sorted((-min(max(sum(int(x) * int(y) for x, y in zip(q[i], v[j])), -(1 << 63)), (1 << 63) - 1), j)
                          for j in range(700) if j != 7 * i)[:5]
            assert sorted(got[i]) == want


def test_query_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(230, 16)).astype(np.float32)
    x[60:90] = x[50]
    rows = [(i, x[i].tolist(), 1) for i in range(230)]
    odd = [(300, None, 1), (350, [1.0] * 3, 1), (351, [None] * 16, 1), (352, [float("nan")] * 16, 1), (353, [float("inf")] * 16, 1),
           (None, [9.0] * 16, 1), (354, [], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank int").repartition(4)
    before = topk.CANDIDATE_BLOCK, topk.QUERY_BLOCK
    topk.CANDIDATE_BLOCK, topk.QUERY_BLOCK = 64, 2
    try:
        got = {tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).collect()}
    finally:
        topk.CANDIDATE_BLOCK, topk.QUERY_BLOCK = before
    assert got == brute(list(range(230)), x)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [0.5]), (1, [-1.0]), (0, [0.25])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 1, -128 * 256), (0, 1, 1, -64 * 256)]
    assert topk.top_k(df.limit(0), df.limit(0)).collect() == []
