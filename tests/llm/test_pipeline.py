"""Each stage's rows against brute force on its own input."""

import collections
import os
import re
import subprocess
import sys

import corpus_pipeline
from tests.llm import test_minhash, test_suffix_dedup
from tests.llm.test_tokens import check_packing

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    tables = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.common.stage_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            tables.append({r.doc_id: r for r in docs.collect()})
            assert len(tables[-1]) == docs.count()
    start, good, exact, near, cut = tables

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = start.keys() - good.keys()
    assert all(good[d] == start[d] for d in good)
    known = [d for d in start if d in labels]
    assert sum((d in gone) == (labels[d] == 0) for d in known) >= 0.95 * len(known)

    groups = collections.defaultdict(list)
    for d, r in good.items():
        groups[re.sub("[\x20\x09-\x0d]", "", r.text)].append((-len(r.text), d))
    assert exact == {min(g)[1]: good[min(g)[1]] for g in groups.values()}

    classes = test_minhash.brute({d: r.text for d, r in exact.items()})
    assert near == {d: exact[d] for d in set(classes.values())}

    texts = {d: r.text for d, r in near.items()}
    for d, (_, n_removed, _, _) in test_suffix_dedup.brute(texts).items():
        r = cut[d]
        assert r.n_chars == (len(r.text) if n_removed else near[d].n_chars)
        assert 0 <= len(texts[d].encode()) - n_removed - len(r.text.encode()) <= 6 * (n_removed // 400)
    assert cut.keys() == near.keys()
    check_packing(docs.collect(), {d: r.text for d, r in cut.items()}, 2048)


def test_run_and_odd_rows(spark, tmp_path):
    """Null, empty, very long and repeated texts, repeated and null ids, a clashing column; and an empty table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(1, None, None, None, None), (1, None, "en", "s", 3), (None, "x" * 90_000, "en", "s", 3),
                                 (None, "", "en", "s", 3)], docs.schema)
    row = collections.Counter
    for k, table in enumerate((docs.union(odd).union(docs.limit(2)), docs.limit(0))):
        sf = f"{tmp_path}/{k}"
        table.withColumn("row_key", table.doc_id).write.parquet(f"{sf}/documents.parquet")
        spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{sf}/labels.parquet")
        now = spark.read.parquet(f"{sf}/documents.parquet")
        columns, rows = now.columns, [row(map(tuple, now.collect()))]
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = corpus_pipeline.common.stage_path(spark, name)
            stage(spark, now, sf).write.parquet(path)
            now = spark.read.parquet(path)
            assert now.columns == columns
            rows.append(row(map(tuple, now.collect())))
        start, good, exact, near, cut = rows
        assert good <= start and exact <= good and near <= exact  # rows go whole, or stay as they are
        plain = lambda r: re.sub("[\x20\x09-\x0d]", "", r[1] or "")
        assert row(map(plain, exact.elements())) == row({plain(r) for r in good})  # one row of each text
        assert all(-len(r[1] or "") <= min(-len(o[1] or "") for o in good if plain(o) == plain(r)) for r in exact)
        classes = test_minhash.brute(dict(enumerate(r[1] or "" for r in exact.elements())))
        assert sum(near.values()) == len(set(classes.values()))
        assert row(r[0] for r in cut.elements()) == row(r[0] for r in near.elements())
        out = corpus_pipeline.run(spark, sf).collect()
        assert (len(out) >= sum(cut.values())) if not k else out == []
        filled = collections.defaultdict(list)
        for r in out:
            filled[r.sequence_id].append((r.offset, r.length))
        for places in filled.values():
            ends = [0]
            for offset, length in sorted(places):
                assert offset == ends[-1] and length > 0
                ends.append(offset + length)
            assert ends[-1] <= 2048


def test_workers_load_only_their_stage():
    """A worker that runs a stage's functions doesn't load pandas (27 MB a worker) or the operators of no stage."""
    code = ("import sys; from lexcurate.llm import common, exact_dedup, minhash, packing, quality, suffix_dedup; "
            "print([m for m in ('pandas', 'lexcurate.llm.topk', 'lexcurate.llm.whitening', 'lexcurate.llm.registry') if m in sys.modules])")
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=REPO).stdout == "[]\n"
