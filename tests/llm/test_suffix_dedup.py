import collections
import hashlib
import random

import pytest

from lexcurate.llm import gsaca, suffix_dedup


def brute(texts, k=400):
    data = {d: (t or "").encode() for d, t in texts.items()}
    seen = collections.Counter(b[i:i + k] for b in data.values() for i in range(len(b) - k + 1))
    out = {}
    for d, b in data.items():
        gone = [False] * len(b)
        end = 0
        for i in range(len(b) - k + 1):
            if seen[b[i:i + k]] > 1:
                for j in range(max(i, end), i + k):
                    gone[j] = True
                end = i + k
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_array_and_prefixes():
    rng = random.Random(0)
    for _ in range(1500):
        x = [rng.randint(1, rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(0, 40))]
        order = gsaca.suffix_array(x)
        assert order == sorted(range(len(x)), key=lambda i: x[i:])
        for k, h in enumerate(gsaca.common_prefixes(x, order)):
            if k:
                a, b = x[order[k - 1]:], x[order[k]:]
                assert a[:h] == b[:h] and (h >= min(len(a), len(b)) or a[h] != b[h])


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefé", k=rng.randint(1, 8))) for _ in range(400)]

    def prose(n):
        out = ""
        while len(out) < n:
            out += rng.choice(words) + " "
        return out[:n]

    passages = [prose(n) for n in (390, 399, 400, 401, 450, 800, 2500, 6000)]
    texts = {}
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.choice([0, 0, rng.randint(0, len(p) // 2)])
            parts += [prose(rng.choice([0, 1, 30, 700])), p[a:rng.choice([len(p), rng.randint(a, len(p))])]]
        texts[i] = "".join(parts)
    texts |= {100: None, 101: "", 102: "x" * 399, 103: "x" * 400, 104: "x" * 401, 105: "ab" * 900, 106: "abc" * 130, 107: texts[5], 108: texts[5]}
    texts[109] = prose(300) * 5  # repeats itself
    texts[110] = prose(3000)
    texts[111] = texts[110][:1500] + "#" + texts[110][1501:]
    return texts


@pytest.mark.parametrize("seed,block", [(1, 1 << 21), (2, 3000), (3, 900)])
def test_against_brute_force(spark, seed, block):
    texts = corpus(seed)
    docs = spark.createDataFrame([(d, t, 7) for d, t in texts.items()], "doc_id long, text string, n_spans int").repartition(5)
    before = suffix_dedup.BLOCK_BYTES
    suffix_dedup.BLOCK_BYTES = block
    try:
        out = suffix_dedup.removed(docs, outputs=True).collect()
    finally:
        suffix_dedup.BLOCK_BYTES = before
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == brute(texts)


def test_rows_follow(spark):
    text = "ä" * 350
    rows = [(1, "A" + text, "en", 351), (1, text + "b", "de", 351), (None, "short", "fr", 5), (2, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    assert sorted((r.text or "", r.n_chars) for r in out.collect() if r.text) == [("A", 1), ("b", 1), ("short", 5)]
    assert suffix_dedup.removed(docs.limit(0)).collect() == []


def test_smaller_blocks_of_the_pipeline_cut_the_same(spark, monkeypatch):
    texts = corpus(4)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    out = suffix_dedup.removed(docs, outputs=True, block_bytes=2000).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == brute(texts)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES_BESIDE", 2000)
    kept = {r.doc_id: r.kept for r in out if r.n_removed}
    left = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs).collect()}
    assert left == {d: kept.get(d, t) for d, t in texts.items()}
