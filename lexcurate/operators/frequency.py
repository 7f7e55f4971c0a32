"""Dictionary-word ratio against a word-frequency list.

T2b builds the list from a clean corpus: zipf(token) = log10(count / total * 1e9).
T2 keeps the tokens of T1 (letters only, lower-cased, 2+ long) and counts a
token as a word when its zipf value is at least the cut (2.0).

The known-word set is bounded: zipf >= c means frequency >= 10^(c-9), and
frequencies sum to one, so at most 10^(9-c) words pass (10 million at 2.0).
It is broadcast when its actual row count is under the limit (checked), else
joined by shuffle. Document tokens are counted per document before the join
(one row per distinct token of a document), so a very frequent word ("the")
is one row per document, not one per occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.functions.text import letter_tokens
from lexcurate.operators.broadcast import DEFAULT_MAX_BROADCAST_BYTES, broadcast_bytes, broadcast_if_small, materialize

DEFAULT_ZIPF_CUT = 2.0


def frequency_list(corpus: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, n, zipf). Partial counts are combined map-side."""
    counts = (corpus.select(F.explode(letter_tokens(text_col)).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    total = counts.select(F.sum("n")).scalar()  # scalar subquery
    return counts.select("token", "n", F.log10(F.col("n") / total * F.lit(1e9)).alias("zipf"))


#: Cells into which words are hashed before they are counted one by one.
CELLS = 1 << 22


def frequent_words(corpus: DataFrame, text_col: str = "text", cut: float = DEFAULT_ZIPF_CUT, cells: int = CELLS) -> DataFrame:
    """T2b for a corpus with more words than are worth a row: (token, n, zipf, total) of the words at or above the cut, exactly.

    Words are hashed into cells and cells counted: a word has no more occurrences than its cell, so
    only words of cells at or above the cut can pass, and only they are counted themselves. The first count shuffles at
    most ``cells`` rows a task, and the second the words of at most 10^(9 - cut) cells: rare words, the bulk of
    a large vocabulary, are never shuffled."""
    tokens = corpus.select(F.explode(letter_tokens(text_col)).alias("token")).withColumn("cell", F.pmod(F.xxhash64("token"), F.lit(cells)))
    counted = materialize(tokens.groupBy("cell").agg(F.count(F.lit(1)).alias("n")))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    passes = F.col("n") * F.lit(1e9) >= F.lit(10.0 ** cut) * total
    heavy = broadcast_if_small(counted.where(passes).select("cell"))
    counts = tokens.join(heavy, "cell", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(passes)
    return counts.select("token", "n", F.log10(F.col("n") / F.lit(max(total, 1)) * F.lit(1e9)).alias("zipf"), F.lit(total).cast("long").alias("total"))


def known_words(freq: DataFrame, cut: float = DEFAULT_ZIPF_CUT) -> DataFrame:
    """Tokens at or above the cut, compared on counts (n * 1e9 >= 10^cut * total),
    which is exact where the log form can round either way at the boundary."""
    # a list of frequent words alone carries the total of all
    total = F.col("total") if "total" in freq.columns else freq.select(F.sum("n")).scalar()
    return freq.where(F.col("n") * F.lit(1e9) >= F.lit(10.0 ** cut) * total).select("token")


def word_ratio_freq(docs: DataFrame, freq: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    cut: float = DEFAULT_ZIPF_CUT, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                    materialize_known: bool = True) -> DataFrame:
    """(id, word_ratio): share of a document's tokens that are known words; 0.0 without tokens."""
    known = known_words(freq, cut).withColumn("__known", F.lit(1))
    if materialize_known:
        known = materialize(known)
    small = broadcast_bytes(known) <= max_broadcast_bytes
    toks = docs.select(F.col(id_col).alias("__id"), F.explode_outer(letter_tokens(text_col)).alias("token"))
    if small:
        # every occurrence is flagged in the scan stage; only per-document
        # partial sums are shuffled
        flagged = toks.join(F.broadcast(known), "token", "left").withColumn("__k", F.lit(1))
        flagged = flagged.withColumn("__k", F.when(F.col("token").isNull(), F.lit(0)).otherwise(F.col("__k")))
    else:
        # shuffle join: count per (document, token) first, so a frequent word
        # is one row per document; AQE splits what is still skewed
        per_doc = toks.groupBy("__id", "token").agg(F.count("token").alias("__k"))
        flagged = per_doc.join(known, "token", "left")
    agg = flagged.groupBy("__id").agg(
        F.sum("__k").alias("__total"),
        F.sum(F.when(F.col("__known") == 1, F.col("__k")).otherwise(F.lit(0))).alias("__good"))
    return agg.select(
        F.col("__id").alias(id_col),
        F.when(F.col("__total") > 0, F.col("__good").cast("double") / F.col("__total").cast("double"))
        .otherwise(F.lit(0.0)).alias("word_ratio"))
