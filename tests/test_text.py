import pytest
from pyspark.sql import functions as F

from lexcurate.functions import text as T


def one(spark, col_fn, values, schema="t string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col_fn(F.col("t"))).collect()]


def test_word_ratio_heuristic_literals(spark):
    got = one(spark, T.word_ratio_heuristic, ["", "a b", "the xyz fly", "1234", "cat's", None])
    assert got == [0.0, 0.0, pytest.approx(1 / 3), 0.0, 1.0, 0.0]


def test_word_count_and_strip(spark):
    assert one(spark, T.word_count, ["", "  a  b\tc\n", "　x y", None, "\x1cz"]) == [0, 3, 2, 0, 1]
    assert one(spark, T.strip_ws, ["  a b \n", " x "]) == ["a b", "x"]


def test_sentences_and_tokens(spark):
    s = one(spark, T.sentences, ["One two. Three four!  Five?Six.\n\nSeven", "  ", "no end"])
    assert s == [["One two.", "Three four!", "Five?Six.", "Seven"], [], ["no end"]]
    assert one(spark, T.token_count, ["Hello, world!", "", "naïve café_1 x"]) == [4, 0, 3]


def test_word_ratio_agrees_with_python_on_documents(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.select("text", T.word_ratio_heuristic(F.col("text")).alias("r"),
                       T.word_count(F.col("text")).alias("n")).collect()

    def py_ratio(text):
        toks = ["".join(c for c in raw if c.isalpha()).lower() for raw in text.split()]
        toks = [t for t in toks if len(t) >= 2]
        if not toks:
            return 0.0
        return sum(1 for t in toks if len(t) >= 3 and any(c in "aeiou" for c in t)) / len(toks)

    for r in rows:
        assert r.n == len(r.text.split())
        assert r.r == pytest.approx(py_ratio(r.text), abs=1e-12)


def test_letter_tokens_follow_word_by_word_lowering(spark):
    samples = ["İSTANBUL İzmir", "Ünİ ab", "x1y2z Ǆemal", "café naïve", "ΣΊΣΥΦΟΣ σοφός"]

    def py_tokens(text):
        toks = ["".join(c for c in raw if c.isalpha()).lower() for raw in text.split()]
        return [t for t in toks if len(t) >= 2]

    got = one(spark, T.letter_tokens, samples)
    assert [list(g) for g in got] == [py_tokens(s) for s in samples]


def test_long_blank_runs_take_linear_time(spark):
    import time

    from pyspark.sql import functions as F

    from lexcurate.functions import text as TX

    df = spark.createDataFrame([("a" + " " * 200_000 + "b",), ("\u3000\x1c " * 70_000,), ("\u2003x\x85",)], "t string")
    df.select(TX.strip_ws("t")).collect()
    began = time.time()
    rows = df.select(TX.strip_ws("t").alias("s"), TX.is_blank("t").alias("b"), TX.word_count("t").alias("n"),
                     F.size(TX.sentences("t")).alias("k")).collect()
    assert time.time() - began < 5
    assert [(len(r.s), r.b, r.n, r.k) for r in rows] == [(200_002, False, 2, 1), (0, True, 0, 0), (1, False, 1, 1)]
