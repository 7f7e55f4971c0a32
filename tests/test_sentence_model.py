"""What is learned from counts, and how it splits."""
import math
import random
import time

from pyspark.sql import functions as F

from lexcurate.operators import chunking, sentence_model as M

WORDS = ["court", "held", "order", "petition", "appeal", "counsel", "bench", "matter", "relief", "statute", "evidence", "hearing"]


def corpus(spark, n=400):
    rng = random.Random(4)
    texts = []
    for i in range(n):
        out = []
        for _ in range(6):
            s = rng.choices(WORDS, k=rng.randint(5, 9))
            s.insert(2, rng.choice(["No. 7", "Smt. Rao", "Ram v. State", "J. Bachmann", "dated", "Dr. Sen"]))
            end = rng.choices([".", "!", "?"], [8, 1, 1])[0]
            out.append(rng.choice(["The", "The", "However"]) + " " + " ".join(s) + end)
        texts.append(" ".join(out))
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_abbreviations_starters_and_collocations_are_learned(spark):
    d = corpus(spark)
    model = M.SentenceModel.of(M.train(d))
    assert {"no", "smt", "v", "dr"} <= set(model.abbreviations) and not set(WORDS) & set(model.abbreviations)
    assert {"the", "however"} <= set(model.starters) and not set(WORDS) & set(model.starters)
    assert ("j", "bachmann") in model.collocations
    got = d.select(F.size(M.sentences("text", model)).alias("n")).distinct().collect()
    assert [r.n for r in got] == [6]  # the rule without a model cuts after No. and v.


def test_split(spark):
    model = M.SentenceModel(["no", "v", "e.g"], ["the"], [("j", "bach")])
    cases = {
        "See No. 7 of it. The end.": ["See No. 7 of it.", "The end."],
        "A v. B was No. The court rose.": ["A v. B was No.", "The court rose."],  # a starter follows the abbreviation
        "By J.  Bach. By J. Smith": ["By J.  Bach.", "By J.", "Smith"],
        "(e.g. this) is. Done!  no. one?\nYes": ["(e.g. this) is.", "Done!", "no. one?", "Yes"],
        " \t ": [], "": [], "No.": ["No."], "no": ["no"], "v. v. v.": ["v. v. v."],
        "é. No.  x. y": ["é.", "No.  x.", "y"]}
    df = spark.createDataFrame([(t,) for t in cases] + [(None,)], "t string")
    got = {r.t: r.s for r in df.select("t", M.sentences("t", model).alias("s")).collect()}
    assert got == cases | {None: None}
    nothing = M.SentenceModel([], [], [])
    from lexcurate.functions.text import sentences

    assert df.where(M.sentences("t", nothing) != sentences("t")).collect() == []


def test_association_is_the_log_likelihood_ratio(spark):
    a, b, both, n = 20, 30, 12, 1000
    ll = lambda k, m, p: k * math.log(p) + (m - k) * math.log(1 - p)
    want = -2 * (ll(both, a, b / n) + ll(b - both, n - a, b / n) - ll(both, a, both / a) - ll(b - both, n - a, (b - both) / (n - a)))
    got = spark.range(1).select(M.association(*[F.lit(x) for x in (a, b, both, n)])).first()[0]
    assert abs(got - want) < 1e-9


def test_no_statistics(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (3, "no stop at all")], "doc_id long, text string")
    assert M.train(d).collect() == [] and M.train(d.limit(0)).collect() == []


def test_chunks_with_a_model(spark):
    d = spark.createDataFrame([(1, "One two No. 7 three. The end of it.")], "doc_id long, text string")
    model = M.SentenceModel(["no"], [], [])
    got = chunking.chunk(d, "text", 8, 0, splitter=lambda t: M.sentences(t, model)).orderBy("chunk_id").collect()
    assert [r.content for r in got] == ["One two No. 7 three.", "The end of it."]


def test_long_words_take_time_in_proportion(spark):
    long = "x" * 400_000
    d = spark.createDataFrame([(1, f"{long} No. 7 of it. The end{'-' * 400_000}a. It is No. 8.")], "doc_id long, text string")
    model = M.SentenceModel(["no"], ["the"], [("j", "bach")])
    M.train(d).collect()
    began = time.time()
    got = d.select(M.sentences("text", model).alias("s")).first().s
    assert got == [f"{long} No. 7 of it.", f"The end{'-' * 400_000}a.", "It is No. 8."]
    assert d.select(M.word_type(F.concat(F.lit("a"), F.repeat(F.lit("-"), 400_000), F.lit("b!"))).alias("t")).first().t == f"a{'-' * 400_000}b"
    assert time.time() - began < 20


ODD = ["No.", "(e.g.", "...", "", "a!", "'É.", "x's", "--", "12.", "ΟΔΟΣ.", "ΣΑΣ,", "İ", "İ.", "_v.", "v._", "no.́", "a.b.c.", "?!", "ﬁ.", "ß", "１２."]


def test_words_are_typed_the_same_in_both_forms(spark):
    core, word_type = M._typing()
    df = spark.createDataFrame([(w,) for w in ODD], "w string")
    got = df.select("w", M.core(F.col("w")).alias("c"), M.word_type(F.col("w")).alias("t")).collect()
    assert [(r.c, r.t) for r in got] == [(core(r.w), word_type(r.w)) for r in got]


def test_words_are_counted_in_the_scan_stage(spark, monkeypatch):
    """By loops over all words, also where a task sends its counts on many times; no row a word leaves the scan."""
    monkeypatch.setattr(M, "HELD_WORDS", 5)
    rng = random.Random(9)
    texts = [rng.choice([" ", "\n\t", "\x1e", "　"]).join(rng.choices(ODD + WORDS, k=rng.randint(0, 40))) for _ in range(80)] + [None, "", " \x1c"]
    d = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    core, word_type = M._typing()
    want = {}
    for t in texts:
        found = (t or "").split()
        for w, f in zip(found, found[1:] + [None]):
            ends = w[-1] in ".!?"
            key = word_type(w), core(w).endswith("."), ends, word_type(f) if ends and f is not None else None
            want[key] = want.get(key, 0) + 1
    counted = M.typed_words(d).groupBy("token", "stopped", "ends", "following").agg(F.sum("n").alias("n"))
    assert {tuple(r)[:4]: r.n for r in counted.collect()} == want
    plan = counted._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_a_large_model_splits_in_batches(spark):
    """What a sentence costs doesn't grow with the model, whose entries are sets and no pattern."""
    starters = [f"w{i}x" for i in range(50_000)]
    model = M.SentenceModel(["no"], starters, [("j", f"b{i}") for i in range(50_000)])
    d = spark.createDataFrame([(1, "No. w7x came. J. B9 met J. Ba. " * 5_000)], "doc_id long, text string")
    began = time.time()
    got = d.select(M.sentences("text", model).alias("s")).first().s
    assert got == ["No.", "w7x came.", "J. B9 met J.", "Ba."] * 5_000
    assert time.time() - began < 20
    assert "ArrowEvalPython" in d.select(M.sentences("text", model))._jdf.queryExecution().toString()
