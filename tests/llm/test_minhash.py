import collections
import itertools
import random

import numpy as np

from lexcurate.llm import minhash


def jaccard(x, y):
    def bag(t):
        t = t.split()
        return collections.Counter(zip(*(t[i:] for i in range(5)))) if len(t) >= 5 else collections.Counter([tuple(t)] * bool(t))

    a, b = bag(x), bag(y)
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def brute(texts, least=0.8):
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sorted(texts), 2):
        if texts[a].split() == texts[b].split() or (texts[a].split() and texts[b].split() and jaccard(texts[a], texts[b]) >= least):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: find(d) for d in texts}


def corpus(rng):
    vocabulary = ["w%d" % i for i in range(300)]
    texts, n = {}, 0
    for size in (3, 6, 40, 120, 400):
        for _ in range(6):
            base = rng.choices(vocabulary, k=size) * rng.choice([1, 1, 3])
            for _ in range(rng.choice([1, 2, 5])):
                copy = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.005, 0.02, 0.05]) else w for w in base]
                texts[n] = rng.choice([" ", "\n"]).join(copy)
                n += 1
    return texts | {1000: "", 1001: "  ", 1002: None, 1003: "one", 1004: "one", 1005: "y " * 30_000, 1006: "y " * 29_000, 1007: "y " * 100}


def test_signature_estimates_weighted_similarity_without_bias():
    rng = np.random.default_rng(4)
    for ca, cb in (((1, 1, 1, 0), (1, 1, 0, 1)), ((5, 1, 9, 2), (4, 3, 3, 2)), ((100, 7, 0, 1), (80, 9, 4, 1))):
        agree, trials, m = 0, 60, 120
        for _ in range(trials):
            h = rng.integers(0, 1 << 63, 4).astype(np.uint64)
            a, b = minhash.signatures([np.repeat(h, ca), np.repeat(h, cb)], m)
            agree += (a == b).sum()
        want = np.minimum(ca, cb).sum() / np.maximum(ca, cb).sum()
        assert abs(agree / trials / m - want) < 4 * (want * (1 - want) / trials / m) ** 0.5 + 0.01


def test_classes_match_brute_force(spark):
    texts = corpus(random.Random(8))
    docs = spark.createDataFrame([(d, t, "x") for d, t in texts.items()], "doc_id long, text string, bands string").repartition(4)
    out = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in out} == brute({d: t or "" for d, t in texts.items()})
    assert sorted(r.doc_id for r in out if r.kept) == sorted({r.class_id for r in out})


def test_rest_of_a_family_in_blocks(spark, monkeypatch):
    """No link is found by rounds here: every pair is left to the exact comparison."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(rng.choice(base) if rng.random() < 0.015 else w for w in base) for i in range(90)}
    texts |= {100 + i: " ".join(f"v{rng.randint(0, 9999)}" for _ in range(30)) for i in range(5)}
    monkeypatch.setattr(minhash, "BLOCK", 16)
    docs = spark.createDataFrame(list(texts.items()), "row_key long, text string")
    links = minhash.rest_links(docs.select("row_key", docs.row_key.alias("root")), docs, 0.8).collect()
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for r in links:
        assert jaccard(texts[r.a], texts[r.b]) >= 0.8
        x, y = sorted((find(r.a), find(r.b)))
        root[y] = x
    same = brute(texts)
    assert {d: find(d) for d in texts} == same and 5 < len(set(same.values())) < 90


def test_chain_of_links_is_one_class(spark):
    base = [f"c{i}" for i in range(200)]
    texts = {}
    for i in range(40):  # neighbours are near, the ends are not
        texts[i] = " ".join(base)
        base[i * 5 % 200] = f"n{i}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()} == brute(texts)


def test_repeated_null_and_no_rows(spark):
    rows = [(1, "a b c d e f", 1), (1, "a b c d e f", 1), (None, "a b c d e f", 2), (2, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    out = minhash.near_duplicates(docs).collect()
    assert len(out) == 4 and sum(r.kept for r in out) == 2
    left = minhash.keep_one(docs)
    assert left.columns == docs.columns and left.count() == 2
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_rows_come_from_python(spark, monkeypatch):
    """Rows made in Python are read by workers of a pool of their own, which stays on the executors."""
    texts = {i: f"a b c d e f g h i j k l m n o p q r s t {i % 3}" for i in range(9)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")

    def refuse(*args, **kwargs):
        raise AssertionError("rows made in Python")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()} == brute(texts)
