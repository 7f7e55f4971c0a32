import random
import re

import pytest

from lexcurate.functions.classify import _python_boundaries, head_regex
from lexcurate.functions.lexicons import get_lexicon
from lexcurate.functions.trie import bounded_regex, trie_regex, whole_regex


@pytest.mark.parametrize("seed", range(5))
def test_found_where_the_flat_alternation_is(spark, seed):
    rng = random.Random(seed)
    letters = "ab.(é" if seed % 2 else "abc अ"
    phrases = ["".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(40)]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(300)] + phrases
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern, whole = trie_regex(phrases), whole_regex(phrases)
    got = {(r.t, r.a, r.b) for r in df.selectExpr("t", f"t rlike {lit(pattern)} a", f"t rlike {lit(whole)} b").collect()}
    assert got == {(t, any(p in t for p in phrases), t in phrases) for t in texts}


def lit(pattern):
    return "r'" + pattern.replace("'", "\\u0027") + "'"


def test_no_phrase():
    assert not re.search(trie_regex([]), "x") and not re.search(trie_regex([]), "") and not re.search(whole_regex([]).replace(r"\z", r"\Z"), "")


def test_longer_word_counts_beside_its_beginning():
    pattern = re.compile(bounded_regex(["ORDER", "ORDER SHEET", "ORDERS"], r"(?<!\w)", r"(?!\w)"))
    assert [bool(pattern.search(t)) for t in ("ORDER.", "ORDERS", "ORDERSX", "ORDER SHEETS", "XORDER", "ORDERSHEET")] == [
        True, True, False, True, False, False]


@pytest.mark.parametrize("name", ["latin", "multi"])
def test_head_patterns_against_one_by_one(spark, name):
    lex = get_lexicon(name, False)
    rng = random.Random(7)
    for patterns in (lex.judgment, lex.order):
        plain = [p.replace(r"\b", "") for p in patterns]
        texts = [a + p + b for p in plain for a, b in (("", ""), ("X", ""), ("", "S"), (" ", "."), ("é", ""), ("", "́"), ("1", ""), ("", "_"))]
        texts += [" ".join(rng.choices([w for p in plain for w in p.split()], k=4)) for _ in range(200)]
        flat = "|".join(f"(?:{_python_boundaries(p)})" for p in patterns)
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        assert df.where(f"(t rlike {lit(flat)}) <> (t rlike {lit(head_regex(patterns))})").collect() == []
