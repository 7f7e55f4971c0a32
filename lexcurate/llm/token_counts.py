"""Token counts by a map-side two-tier lookup.

Tier one is a broadcast table of frequent words and their token numbers, found
by counting the words of all rows in the tasks (it only saves time; no count depends on it):
each task names its most frequent words, a bounded number, and only these are added up.
Tier two encodes the words that it lacks through a bounded cache in each
worker. No word of a text crosses a shuffle.

Defined cases: null text counts as empty (0 tokens, 0 bytes); repeated rows
and null ids give one row each; an empty table gives no rows; other columns
of the input are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.llm import common, words

#: Entries of the frequent-word table: the bound of what is broadcast. Words that a task holds while it counts, and those that it names.
TABLE_WORDS, HELD_WORDS, SKETCH_WORDS = 1 << 16, 300_000, 1 << 13


def frequent(docs: DataFrame) -> DataFrame:
    """(word, c): the words of the highest counts of each task, at most SKETCH_WORDS, with a lower bound of their count.

    A task counts all its words in bounded space: when HELD_WORDS are held, the median count is taken off all of them, and
    the words that are used up go (so no word is undercounted by more than the sum of what was taken off)."""
    def rows(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not words.ODD_SPACE.search(text):
                    held.update(text.split())
                    if len(held) > HELD_WORDS:
                        less = sorted(held.values())[len(held) // 2]
                        held = Counter({w: c - less for w, c in held.items() if c > less})
        top = [(w, c) for w, c in held.most_common(SKETCH_WORDS) if c > 1 and len(w) <= words.CACHE_LETTERS]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([c for _, c in top], pa.int64())], names=["word", "c"])

    some = docs.where("text is not null").select("text")
    return some.mapInArrow(rows, "word string, c long")


def frequent_words(docs: DataFrame, path: str, most: int = TABLE_WORDS) -> tuple[str, bytes]:
    """(words joined by blanks, one byte of token number each): the words with the highest counts in the tasks' sketches over all
    rows, equal ones all or none, at most ``most``."""
    counts = common.table(frequent(docs).groupBy("word").agg(F.sum("c").alias("c")), "sketches").withColumn(
        "bin", F.when(F.col("c") < 4096, F.col("c")).otherwise(4096 + F.floor(F.log(F.col("c") / 4096) * 512)))
    floor, held = 1 << 62, 0  # from a histogram with a fixed number of bins, as in maxent_lm.lexicon
    for r in counts.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("bin")).collect():
        if (held := held + r.n) > most:
            break
        floor = r.bin

    def encode(batches):
        for batch in batches:
            n = [len(words.encoder(path).word(w)) // 4 for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["word", "n"])

    top = counts.where(F.col("bin") >= floor).select("word").mapInArrow(encode, "word string, n long").where("n < 256").collect()
    return " ".join(r.word for r in top), bytes(r.n for r in top)


@words.worker_cache("tokens")
def _lengths(path: str, table_words: str, table_lengths: bytes) -> words.Bounded:
    enc = words.encoder(path)
    first = dict(zip(table_words.split(" "), table_lengths)) if table_lengths else {}

    def length(word: str) -> int:
        n = first.get(word)
        return len(enc.word(word)) // 4 if n is None else n

    cache = words.Bounded(length)
    cache.update(first)
    return cache


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 2048) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit."""
    path = path or words.tokenizer_path()
    table = docs.sparkSession.sparkContext.broadcast(frequent_words(docs, path))

    def count(batches):
        lengths = _lengths(path, *table.value)
        for batch in batches:
            n = []
            for text in batch.column(1).to_pylist():
                if words.ODD_SPACE.search(text):
                    n.append(len(words.encoder(path).whole(text)) // 4)
                else:
                    n.append(sum(map(lengths.__getitem__, text.split())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    return (docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
            .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.documents(spark, sf_dir))
