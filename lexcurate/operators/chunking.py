"""Sentence-aligned, token-bounded chunks with overlap.

Rules (per document, sentences s_0..s_{m-1} with token counts t_i):
  walk the sentences holding a current chunk of n tokens; when n + t_i is
  over ``max_tokens`` close the current chunk (even when it is empty), then
  start the next one with the longest tail of whole sentences of the closed
  chunk whose token sum is at most ``overlap``, plus s_i. Otherwise append
  s_i. At the end emit what is held. A sentence is never split, so a chunk
  can exceed ``max_tokens``; a first sentence longer than the limit gives an
  empty chunk 0.

The fold runs over sentence *indexes* inside one row with Spark's
``aggregate`` higher-order function, producing (start, end) bounds; the
chunk texts are built once at the end. No shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.functions.text import sentences as split_sentences, token_count

DEFAULT_MAX_TOKENS = 2000
DEFAULT_OVERLAP = 100

_BOUNDS_TYPE = "array<struct<s:int,e:int>>"


def _bounds(T: Column, max_tokens: int, overlap: int) -> Column:
    """Chunk (start, end) sentence indexes from the token-count array ``T``."""
    m = F.size(T)

    def tok(i):
        return F.element_at(T, i + 1).cast("long")

    def step(acc, i):
        t = tok(i)
        close = acc["n"] + t > F.lit(max_tokens)
        # longest tail of the closed chunk (acc.s .. i-1) whose sum is <= overlap
        back = F.when(i > acc["s"], F.sequence(i - 1, acc["s"], F.lit(-1))) \
            .otherwise(F.array().cast("array<int>"))
        tail = F.aggregate(
            back,
            F.struct(i.alias("j"), F.lit(0).cast("long").alias("sum"), F.lit(False).alias("stop")),
            lambda o, j: F.when(
                o["stop"] | (o["sum"] + tok(j) > F.lit(overlap)),
                F.struct(o["j"].alias("j"), o["sum"].alias("sum"), F.lit(True).alias("stop")),
            ).otherwise(
                F.struct(j.alias("j"), (o["sum"] + tok(j)).alias("sum"), F.lit(False).alias("stop"))
            ),
        )
        closed = F.struct(
            tail["j"].alias("s"),
            (tail["sum"] + t).alias("n"),
            F.concat(acc["b"], F.array(F.struct(acc["s"].alias("s"), (i - 1).alias("e")))).alias("b"),
        )
        kept = F.struct(acc["s"].alias("s"), (acc["n"] + t).alias("n"), acc["b"].alias("b"))
        return F.when(close, closed).otherwise(kept)

    init = F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("n"), F.array().cast(_BOUNDS_TYPE).alias("b"))
    idx = F.when(m > 0, F.sequence(F.lit(0), m - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(
        idx, init, step,
        lambda acc: F.when(m > 0, F.concat(acc["b"], F.array(F.struct(acc["s"].alias("s"), (m - 1).alias("e")))))
        .otherwise(acc["b"]),
    )


def chunk_array(text, max_tokens: int = DEFAULT_MAX_TOKENS, overlap: int = DEFAULT_OVERLAP,
                counter=token_count, splitter=split_sentences) -> Column:
    """Array of chunk texts for a text column (T10 split, ``counter`` per sentence)."""
    text = F.col(text) if isinstance(text, str) else text

    def build(x):
        S, T = x["S"], x["T"]
        return F.transform(
            _bounds(T, max_tokens, overlap),
            lambda b: F.array_join(F.slice(S, b["s"] + 1, b["e"] - b["s"] + 1), " "),
        )

    S = splitter(text)
    # bind the sentence array once, then its token counts once: lambdas do
    # not share sub-expressions, and the fold reads T many times per row
    bound = F.transform(F.array(S), lambda s: F.struct(s.alias("S"), F.transform(s, lambda x: counter(x)).alias("T")))
    return F.element_at(F.transform(bound, build), 1)


def chunks_and_tokens(text, max_tokens: int = DEFAULT_MAX_TOKENS, overlap: int = DEFAULT_OVERLAP,
                      counter=token_count, splitter=split_sentences) -> Column:
    """struct(chunks array, tokens long) from one sentence split and one count per sentence.

    For an additive counter (the default: tokens never span whitespace, and
    sentences split only at whitespace) the document's token count is the
    sum of its sentences' counts, so the text is not scanned a second time.
    """
    text = F.col(text) if isinstance(text, str) else text

    def build(x):
        S, T = x["S"], x["T"]
        chunks = F.transform(_bounds(T, max_tokens, overlap),
                             lambda b: F.array_join(F.slice(S, b["s"] + 1, b["e"] - b["s"] + 1), " "))
        total = F.aggregate(T, F.lit(0).cast("long"), lambda acc, t: acc + t.cast("long"))
        return F.struct(chunks.alias("chunks"), total.alias("tokens"))

    bound = F.transform(F.array(splitter(text)),
                        lambda s: F.struct(s.alias("S"), F.transform(s, lambda x: counter(x)).alias("T")))
    return F.element_at(F.transform(bound, build), 1)


def chunk(df: DataFrame, text_col: str = "text", max_tokens: int = DEFAULT_MAX_TOKENS,
          overlap: int = DEFAULT_OVERLAP, keep=("*",), counter=token_count,
          chunk_id_col: str = "chunk_id", content_col: str = "content",
          count_col: str | None = None, splitter=split_sentences) -> DataFrame:
    """One row per chunk: ``keep`` columns + chunk position + chunk text.

    With ``count_col`` set, the number of chunks of the document is kept on
    every row too (the reference counts chunks before embedding them).
    """
    arr = chunk_array(text_col, max_tokens, overlap, counter, splitter)
    # one struct per chunk, built from the array bound once (see langid.detect)
    def rows(a):
        return F.transform(a, lambda x, i: F.struct(
            i.alias(chunk_id_col), x.alias(content_col), *([F.size(a).alias(count_col)] if count_col else [])))

    return df.select(*keep, F.inline(F.element_at(F.transform(F.array(arr), rows), 1)))
