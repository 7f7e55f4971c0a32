"""Token counts, BPE and packing against the tokenizers library itself."""

import collections
import hashlib
import random
import zlib

import pytest
from tokenizers import Tokenizer

from lexcurate.llm import bpe, packing, token_counts, words

PATH = words.tokenizer_path()
TEXTS = [
    None, "", " ", "a", "It's we'll don'T 'S", "x" * 5000, "ab " * 6000, "née naïve über größe!", "éa é. café",
    "<|endoftext|> a<|startoftext|>b <|x", "tab\tnew\nline\r\x0b\x0c", "odd\x1cspace\x85and​zero﻿", "日本語の文章。テスト １２３ ½ Ⅷ",
    "👍🏽 emoji‍join", "İstanbul ΣΑΣ ǅ ß", "non breaking em　wide", "\x00nul\x01", "1234.5,6 7!!", "a" * 30 + "́" * 40,
    "word.,!|;: |||", "̸< ≠ a̸", "Hindi निर्णय किया", "dup text here", "dup text here",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "null id", "y"), (3, "repeated id", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)


def ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_word_encoder_on_random_texts():
    rng, alphabet = random.Random(5), "aB '.,1é́ßN\n\t|<! 字İ-"
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert words.encode_bytes(PATH, text) == words.to_bytes(ids_cached(text)), repr(text)


_T = Tokenizer.from_file(PATH)


def ids_cached(text):
    return _T.encode(text, add_special_tokens=False).ids


def test_counts(docs):
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs).collect())
    want = sorted((d is None, d, len((t or "").encode()), len(ids_cached(t or "")), len(ids_cached(t or "")) > 2048)
                  for d, t, _ in (tuple(r) for r in docs.collect()))
    assert got == want


def test_bpe_round_trip(docs):
    got = collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(docs).collect())
    want = collections.Counter()
    for d, t, _ in (tuple(r) for r in docs.collect()):
        e = ids_cached(t or "")
        want[d, len(e), hashlib.sha256(words.to_bytes(e)).hexdigest(),
             hashlib.sha256(_T.decode(e, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == want


def test_chunk_borders_are_repaired():
    rng, enc = random.Random(1), bpe.Chunks(PATH)
    for spaces in (" ", " \n\t", " ", ""):
        text = "".join(rng.choice("abcé1.'" + spaces) for _ in range(60_000))
        e = ids_cached(text)
        assert enc.text(text) == (words.to_bytes(e), _T.decode(e, skip_special_tokens=False))


def check_packing(rows, texts, limit):
    by_doc, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end <= limit
    for d, t in texts.items():
        e, at = ids_cached(t or "") + [0], 0
        for k, r in enumerate(sorted(by_doc[d], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.length) == (k, at, min(limit, len(e) - at))
            assert r.ids_crc32 == zlib.crc32(words.to_bytes(e[at:at + r.length]))
            at += r.length
        assert at == len(e)
    return len(sequences)


def test_packing(spark):
    rng = random.Random(2)
    texts = dict(enumerate(TEXTS)) | {100 + i: "the " * rng.randint(0, 3000) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    n = check_packing(packing.pack(docs).collect(), texts, 2048)
    total = sum(len(ids_cached(t or "")) + 1 for t in texts.values())
    assert n <= total / 2048 * 1.02 + 1


def test_plan_uses_every_piece_once():
    rng = random.Random(3)
    for _ in range(60):
        limit = rng.choice([8, 50, 300])
        hist = {rng.randint(1, limit): rng.randint(1, 40) for _ in range(rng.randint(1, 40))}
        used = collections.Counter()
        for pattern, times in packing.plan(hist, limit):
            assert sum(pattern) <= limit and times > 0
            for n in pattern:
                used[n] += times
        assert used == hist


def test_hot_length_takes_exact_complements():
    assert sum(t for _, t in packing.plan({1000: 1_000_000, 1048: 400_000, 524: 1_200_000}, 2048)) == 1_000_000


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(none).count() == bpe.encode(none).count() == packing.pack(none).count() == 0


def test_frequent_words_come_from_all_rows(spark):
    rows = [(i, "early early") for i in range(3000)] + [(i, "late late late") for i in range(3000, 6000)] + [(9000, "seldom"), (9001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert token_counts.frequent_words(docs, PATH, most=2)[0].split() in (["early", "late"], ["late", "early"])
    assert token_counts.frequent_words(docs, PATH, most=1)[0] == "late"
    assert token_counts.frequent_words(docs.limit(0), PATH) == ("", b"")


def test_latin_words_equal_the_library():
    import itertools
    import random

    from lexcurate.llm import words

    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)] if chr(c).isalpha()]
    rng = random.Random(5)
    some = [*letters, *("".join(p) for p in itertools.product(letters[52:], "aZé")), *("".join(rng.choices(letters, k=rng.randint(2, 14))) for _ in range(3000))]
    some += [w + m for w in some[::7] for m in (".", ",!", "|")] + ["µ", "aªb", "ºx", "straße", "İstanbul", "ΣΑΣ", "e\u0301tat", "naïve's", "élan-vital"]
    enc = words.WordEncoder(PATH)
    assert all(enc.word(w) == enc.whole(w) for w in some)
