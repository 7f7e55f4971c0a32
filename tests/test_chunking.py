from pyspark.sql import functions as F

from lexcurate.functions import text as T
from lexcurate.operators import chunking as CH


def loop_chunks(S, counts, mx, ov):
    """Plain loop over sentences: the rule the fold must equal."""
    chunks, cur, cur_t, n = [], [], [], 0
    for s, t in zip(S, counts):
        if n + t > mx:
            chunks.append(" ".join(cur))
            keep, keep_t, c = [], [], 0
            for ps, pt in zip(reversed(cur), reversed(cur_t)):
                if c + pt > ov:
                    break
                keep.insert(0, ps)
                keep_t.insert(0, pt)
                c += pt
            cur, cur_t = keep + [s], keep_t + [t]
            n = sum(cur_t)
        else:
            cur.append(s)
            cur_t.append(t)
            n += t
    if cur:
        chunks.append(" ".join(cur))
    return chunks


def words_per_sentence(s):
    return F.size(F.split(s, " ")).cast("long")


def test_fixture_cases(spark):
    df = spark.createDataFrame([
        ("x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12.",),   # 12 tokens, max 10
        ("a b c d. e f g h. i j k l.",),                 # 4, 4, 4
        ("a b c d e. f g h i j. k l m n o.",),           # 5, 5, 5
        ("a b c d. e f. g h. i j k l.",),                # 4, 2, 2, 4
        ("",),
    ], "text string")
    got = [r.c for r in df.select(CH.chunk_array("text", 10, 4, counter=words_per_sentence).alias("c")).collect()]
    assert got == [
        ["", "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12."],
        ["a b c d. e f g h.", "e f g h. i j k l."],
        ["a b c d e. f g h i j.", "k l m n o."],
        ["a b c d. e f. g h.", "e f. g h. i j k l."],
        [],
    ]


def test_fold_equals_loop_on_documents(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for mx, ov in ((200, 40), (2000, 100), (50, 0)):
        rows = docs.select(T.sentences("text").alias("S"), CH.chunk_array("text", mx, ov).alias("C")) \
            .withColumn("N", F.transform("S", lambda s: T.token_count(s))).collect()
        for r in rows:
            assert list(r.C) == loop_chunks(r.S, r.N, mx, ov)


def test_chunk_rows_keep_columns_and_count(spark):
    df = spark.createDataFrame([(1, "a b. c d. e f."), (2, "")], "id long, text string")
    rows = CH.chunk(df, "text", 3, 1, keep=("id",), counter=words_per_sentence, count_col="n").collect()
    assert [(r.id, r.chunk_id, r.content, r.n) for r in rows] == [(1, 0, "a b.", 3), (1, 1, "c d.", 3),
                                                                    (1, 2, "e f.", 3)]


def test_fold_equals_loop_random_layouts(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    doc = st.lists(st.integers(min_value=1, max_value=15), min_size=0, max_size=25)
    batch = st.lists(st.tuples(doc, st.sampled_from([1, 3, 8, 20]), st.sampled_from([0, 2, 6])),
                     min_size=60, max_size=60)

    @settings(max_examples=3, deadline=None)
    @given(batch)
    def check(cases):
        rows, expected = [], []
        for n, (counts, mx, ov) in enumerate(cases):
            sents = [" ".join(f"w{n}s{k}t{j}" for j in range(t)) + "." for k, t in enumerate(counts)]
            rows.append((n, " ".join(sents), mx, ov))
            expected.append(loop_chunks(sents, counts, mx, ov))
        df = spark.createDataFrame(rows, "id long, text string, mx int, ov int")
        # limits are per-row literals here: group the batch by (mx, ov)
        got = {}
        for mx, ov in {(r[2], r[3]) for r in rows}:
            part = df.where((df.mx == mx) & (df.ov == ov))
            for r in part.select("id", CH.chunk_array("text", mx, ov, counter=words_per_sentence).alias("c")).collect():
                got[r.id] = list(r.c)
        assert [got[i] for i in range(len(rows))] == expected

    check()


def test_sentence_token_sum_equals_text_count(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text")
    odd = spark.createDataFrame([("A.\u001eB! c? d. e f.  ",), ("",), ("...",), ("x" * 5 + ". \x1c y",)],
                                "text string")
    for df in (docs, odd):
        rows = df.select(T.token_count("text").alias("n"), CH.chunks_and_tokens("text", 200, 40).alias("ct")).collect()
        assert all(r.n == r.ct.tokens for r in rows)
