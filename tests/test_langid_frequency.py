from pyspark.sql import functions as F

from lexcurate.operators import langid, frequency


def test_trigrams_and_detection(spark):
    corpus = spark.createDataFrame(
        [("the cat and the dog and the house", "en"), ("le chat et le chien et la maison", "fr")] * 3,
        "text string, lang string")
    prof = langid.train_profiles(corpus)
    det = langid.NaiveBayesDetector(prof)
    probe = spark.createDataFrame([(1, "the house and the cat"), (2, "le chien et la maison"), (3, "  1234 "),
                                   (4, None)], "id long, text string")
    got = {r.id: (r.lang, r.prob) for r in det.detect(probe, "id", "text").collect()}
    assert got[1][0] == "en" and got[2][0] == "fr"
    assert got[3] == (None, 0.0) and got[4] == (None, 0.0)
    assert 0.5 < got[1][1] <= 1.0
    grams = spark.createDataFrame([("Ab, c",)], "t string").select(langid.trigrams("t")).first()[0]
    assert grams == [" ab", "ab ", "b c", " c "]


def test_zipf_cut_on_literal_table(spark):
    # total 1e7: zipf(n) = log10(n / 1e7 * 1e9) = log10(100 n); cut 2.0 <=> n >= 1, cut 3.0 <=> n >= 10
    freq = spark.createDataFrame([("the", 9_999_989), ("court", 10), ("rare", 1)], "token string, n long")
    freq = freq.withColumn("zipf", F.log10(F.col("n") / F.lit(1e7) * F.lit(1e9)))
    assert sorted(r.token for r in frequency.known_words(freq, 3.0).collect()) == ["court", "the"]
    assert sorted(r.token for r in frequency.known_words(freq, 2.0).collect()) == ["court", "rare", "the"]
    docs = spark.createDataFrame([(1, "The court, the RARE x"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r.word_ratio for r in frequency.word_ratio_freq(docs, freq, cut=3.0).collect()}
    assert got == {1: 0.75, 2: 0.0}


def test_vowel_signs_stay_in_their_words(spark):
    from lexcurate.operators.langid import normalized

    texts = {"hi": "\u0928\u093f\u0930\u094d\u0923\u092f \u0915\u093f\u092f\u093e \u0917\u092f\u093e", "mr": "\u0928\u094d\u092f\u093e\u092f\u093e\u0932\u092f\u093e\u0928\u0947 \u0906\u0926\u0947\u0936 \u0926\u093f\u0932\u093e",
             "te": "\u0c24\u0c40\u0c30\u0c4d\u0c2a\u0c41 \u0c07\u0c1a\u0c4d\u0c1a\u0c3e\u0c30\u0c41"}
    df = spark.createDataFrame([(k, t + " 12, (3)") for k, t in texts.items()], "k string, t string")
    assert {r.k: r.n.split() for r in df.select("k", normalized("t").alias("n")).collect()} == {k: t.split() for k, t in texts.items()}


def test_frequent_words_are_exact_and_rare_ones_are_not_shuffled(spark):
    import random
    from collections import Counter

    from lexcurate.operators import frequency

    rng = random.Random(2)
    word = lambda i: "w" + "".join(chr(97 + int(d)) for d in str(i))
    texts = [" ".join([word(rng.randrange(20))] * 3 + [word(rng.randrange(10 ** 6)) for _ in range(20)]) for _ in range(500)]
    d = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    counts = Counter(w for t in texts for w in t.split())
    total = sum(counts.values())
    cut = 6.5
    want = {w: n for w, n in counts.items() if n * 1e9 >= 10 ** cut * total}
    for cells in (16, 1 << 16):  # shared cells let more words through to the count, and no other result
        got = frequency.frequent_words(d, cut=cut, cells=cells)
        assert {r.token: r.n for r in got.collect()} == want and {r.total for r in got.collect()} == {total}
    full = frequency.known_words(frequency.frequency_list(d), cut)
    assert {r.token for r in frequency.known_words(got, cut).collect()} == {r.token for r in full.collect()} == set(want)
    assert frequency.frequent_words(d.limit(0)).collect() == []


def test_trigrams_are_counted_by_code_points_once_a_document(spark, monkeypatch):
    corpus = spark.createDataFrame([("a", "𝐀𝐁𝐂𝐃"), ("b", "xyz " * 500), ("b", None), (None, "abc")], "lang string, text string")
    got = {(r.lang, r.gram): r.n for r in langid.train_profiles(corpus).collect()}
    assert got == {("a", g): 1 for g in (" 𝐀𝐁", "𝐀𝐁𝐂", "𝐁𝐂𝐃", "𝐂𝐃 ")} | {("b", " xy"): 500, ("b", "xyz"): 500, ("b", "yz "): 500, ("b", "z x"): 499, ("b", "z  "): 1}
    det = langid.NaiveBayesDetector(langid.train_profiles(corpus))
    docs = spark.createDataFrame([(1, "𝐀𝐁𝐂𝐃 𝐀𝐁"), (2, "xyz " * 10_000), (3, ""), (4, "1 2"), (5, None), (6, "́")], "id long, text string")
    assert {r.id: r.lang for r in det.detect(docs, "id", "text").collect()} == {1: "a", 2: "b", 3: None, 4: None, 5: None, 6: None}
    counts = langid.gram_counts(docs, "id", "text").where("__id = 2").collect()  # not a row an occurrence
    assert len(counts) == 5 and sum(r["__c"] for r in counts) == 40_000
    whole = [k.tolist() for k in langid.gram_keys(" abcde 𝐀 ")]
    monkeypatch.setattr(langid, "BLOCK", 3)
    parts = [k.tolist() for k in langid.gram_keys(" abcde 𝐀 ")]
    assert len(parts) > 1 and [k for p in parts for k in p] == whole[0] and not list(langid.gram_keys("  "))
