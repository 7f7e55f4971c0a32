"""Sentence boundaries from a trained model (Kiss and Strunk, 2006).

Which words end in a full stop that is theirs (``No.``, ``v.``), and not the sentence's, is learned from
counts alone, without labels. Words are counted in the scan stage, in Arrow batches, and added up by Spark;
log-likelihood ratios decide:

* abbreviation: the word seldom goes without its full stop, weighted for short words and
  inner full stops
* collocation: an initial or a number with a full stop and the word after it come together
  more often than chance (``J. Bach``, ``2. Teil``)
* starter: a word that comes after a sentence's end more often than chance

A full stop between white space ends a sentence unless its word is an abbreviation and no
starter follows, or it is part of a collocation. ``!`` and ``?`` always do. Texts are split in Arrow batches too,
with the model's entries as sets.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexcurate.operators.broadcast import broadcast_if_small, materialize

# FIXED VALUES — the thresholds of the published method, and the share of an abbreviation's occurrences expected with a full stop.
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
EXPECTED = 0.99
#: An abbreviation is seen with its full stop this often at least; likewise a pair.
LEAST_SEEN = 2
# letters, with inner full stops; initials and numbers
SHAPE, ORDINAL, WORD = r"^\p{L}+(\.\p{L}+)*$", r"^(\p{L}|\p{N}+)$", r"^\p{L}+$"
_HEAD, _TAIL = r"^[^\p{L}\p{N}]+", r"[^\p{L}\p{N}]+$"
_UP_TO_LAST = r"(?s)\A.*[\p{L}\p{N}]"  # what is left without _TAIL, in linear time
_MARK = "\u001e"
#: Distinct words, and words with the one after them, that a task counts before it sends its counts on.
HELD_WORDS = 500_000


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, also inside another lambda, where sub-expressions aren't shared."""
    return F.element_at(F.transform(F.array(value), use), 1)


def core(word: Column) -> Column:
    """Lower case, without marks before the first letter or digit."""
    return F.lower(F.regexp_replace(word, _HEAD, ""))


def word_type(word: Column) -> Column:
    """The word without its full stop, or without any marks that end it."""
    return _bound(core(word), lambda c: F.when(F.endswith(c, F.lit(".")), F.substring(c, F.lit(1), F.length(c) - 1))
                  .otherwise(F.regexp_extract(c, _UP_TO_LAST, 0)))


def _typing():
    """``core`` and ``word_type`` of one word, in Python: what tasks carry with them, so that their workers needn't have this package."""
    head, tail = re.compile(r"[\W_]*"), re.compile(r"(?s).*[^\W_]")  # Python's \w is a letter, a number or _

    def core(word):
        return word[head.match(word).end():].lower()

    def word_type(word):
        c = word.lower()
        if word.isalnum() and c.isalnum():  # no mark to take off
            return c
        c = core(word)
        if c.endswith("."):
            return c[:-1]
        return m[0] if (m := tail.match(c)) else ""

    return core, word_type


def x_log_y(x: Column, y: Column) -> Column:
    return F.when(x == 0, F.lit(0.0)).otherwise(x * F.log(y))


def association(a: Column, b: Column, both: Column, n: Column) -> Column:
    """Log-likelihood ratio of two words coming together ``both`` times, of ``a`` and ``b`` times alone, in ``n`` words."""
    p, p1, p2 = b / n, both / a, (b - both) / (n - a)
    rest = n - a - b + both
    apart = x_log_y(both, p) + x_log_y(a - both, 1 - p) + x_log_y(b - both, p) + x_log_y(rest, 1 - p)
    joint = x_log_y(both, p1) + x_log_y(a - both, 1 - p1) + x_log_y(b - both, p2) + x_log_y(rest, 1 - p2)
    return -2.0 * (apart - joint)


def typed_words(texts: DataFrame) -> DataFrame:
    """(token, stopped, ends, following, n) of the words of the texts, the one column: a word's type, whether it has a full stop, whether a
    mark that may end a sentence is its last character, the type of the next word. That matters after such a mark alone, and is
    null after all other words. Rows of a task are added up, but not yet those of several."""
    most, (core, word_type) = HELD_WORDS, _typing()

    def rows(batches):
        words, pairs = Counter(), Counter()

        def out():
            # words as written were counted first: types are worked out once a distinct one
            single = [w for w in words if w[-1] not in ".!?"]
            none = len(single)
            yield pa.RecordBatch.from_arrays([
                pa.array([word_type(w) for w in chain(single, (w for w, _ in pairs))], pa.string()),
                pa.array([False] * none + [core(w).endswith(".") for w, _ in pairs], pa.bool_()), pa.array([False] * none + [True] * len(pairs), pa.bool_()),
                pa.array([None] * none + [None if f is None else word_type(f) for _, f in pairs], pa.string()),
                pa.array([*(words[w] for w in single), *pairs.values()], pa.int64())], names=["token", "stopped", "ends", "following", "n"])
            words.clear()
            pairs.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = (text or "").split()  # at any white space of WHITESPACE_CLASS
                words.update(found)
                pairs.update([(w, f) for w, f in zip(found, chain(found[1:], (None,))) if w[-1] in ".!?"])
                if len(words) + len(pairs) > most:
                    yield from out()
        yield from out()

    return texts.mapInArrow(rows, "token string, stopped boolean, ends boolean, following string, n long")


def train(corpus: DataFrame, text_col: str = "text") -> DataFrame:
    """(kind, token, following, n, score): the model's entries. ``following`` is null but for collocations."""
    # one pass over the texts: every statistic is a sum over these rows
    pairs = materialize(typed_words(corpus.select(F.col(text_col).cast("string")))
                        .groupBy("token", "stopped", "ends", "following").agg(F.sum("n").alias("n")))
    types = pairs.groupBy("token").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("stopped"), F.col("n")).otherwise(0)).alias("n_stopped"))
    types = materialize(types)
    total, stops = types.agg(F.sum("n"), F.sum("n_stopped")).first()
    empty = pairs.sparkSession.createDataFrame([], "kind string, token string, following string, n long, score double")
    if not total or not 0 < stops < total:
        return empty

    n, with_stop = F.col("n"), F.col("n_stopped")
    letters = F.length(F.replace("token", F.lit("."), F.lit("")))
    p = stops / total
    null = with_stop * F.log(F.lit(p)) + (n - with_stop) * F.log(F.lit(1 - p))
    alternative = with_stop * F.log(F.lit(EXPECTED)) + (n - with_stop) * F.log(F.lit(1 - EXPECTED))
    score = (-2.0 * (null - alternative) * F.exp(-letters.cast("double")) * (F.length("token") - letters + 1)
             * F.pow(letters.cast("double"), -(n - with_stop).cast("double")))
    abbreviations = (types.where(F.col("token").rlike(SHAPE) & (with_stop >= LEAST_SEEN)).withColumn("score", score)
                     .where(F.col("score") >= ABBREVIATION)
                     .select(F.lit("abbreviation").alias("kind"), "token", F.lit(None).cast("string").alias("following"), with_stop.alias("n"), "score"))
    abbreviations = materialize(abbreviations)
    short = broadcast_if_small(abbreviations.select("token", F.lit(True).alias("abbreviated")))

    followed = pairs.where(F.col("following").rlike(WORD))
    ends = followed.where("ends").join(short, "token", "left").where(~(F.col("stopped") & F.coalesce("abbreviated", F.lit(False))))
    after = ends.groupBy("following").agg(F.sum("n").alias("both"))
    n_ends = after.agg(F.coalesce(F.sum("both"), F.lit(0))).first()[0]
    own = types.select(F.col("token").alias("following"), F.col("n").alias("alone"))
    starters = (after.join(own, "following").withColumn("score", association(F.lit(n_ends), F.col("alone"), F.col("both"), F.lit(total)))
                .where((F.col("score") >= STARTER) & (F.col("both") * F.lit(total) > F.col("alone") * F.lit(n_ends)))
                .select(F.lit("starter").alias("kind"), F.col("following").alias("token"), F.lit(None).cast("string").alias("following"),
                        F.col("both").alias("n"), "score")) if 0 < n_ends < total else empty
    starters = materialize(starters)

    two = followed.where(F.col("stopped") & F.col("token").rlike(ORDINAL)).groupBy("token", "following").agg(F.sum("n").alias("both")).where(F.col("both") >= LEAST_SEEN)
    two = two.join(types.select("token", F.col("n_stopped").alias("first")), "token").join(own, "following")
    collocations = (two.withColumn("score", association(F.col("first"), F.col("alone"), F.col("both"), F.lit(total)))
                    .where((F.col("score") >= COLLOCATION) & (F.col("both") * F.lit(total) > F.col("alone") * F.col("first")))
                    .join(broadcast_if_small(starters.select(F.col("token").alias("following"))), "following", "left_anti")
                    .select(F.lit("collocation").alias("kind"), "token", "following", F.col("both").alias("n"), "score"))
    return abbreviations.unionByName(starters).unionByName(collocations)


@dataclass
class SentenceModel:
    """The model's entries as patterns: what the splitter carries into its tasks."""

    abbreviations: list[str]
    starters: list[str]
    collocations: list[tuple[str, str]]

    @classmethod
    def of(cls, entries: DataFrame) -> SentenceModel:
        """Reads the entries on the driver: what passes the thresholds is a small part of the vocabulary, never the pairs."""
        rows = entries.select("kind", "token", "following").collect()
        of_kind = lambda k: sorted(r.token for r in rows if r.kind == k)
        return cls(of_kind("abbreviation"), of_kind("starter"), sorted((r.token, r.following) for r in rows if r.kind == "collocation"))

    def splitter(self):
        """``text -> sentences`` in Python, with all that it needs in the tasks."""
        abbreviations, starters = set(self.abbreviations), set(self.starters)
        pairs, firsts = {" ".join(c) for c in self.collocations}, {c[0] for c in self.collocations}
        boundary, mark, (core, word_type) = re.compile(r"([.!?])(\s+)"), _MARK, _typing()

        def joins(word, after):
            """Does the full stop after ``word`` belong to it? ``after`` is the text up to the next mark."""
            first = core(word)
            if not first.endswith("."):
                return False
            first = first[:-1]
            abbreviation = first in abbreviations
            if not abbreviation and first not in firsts:
                return False
            following = after.split(None, 1)
            second = word_type(following[0]) if following else ""
            return (abbreviation and second not in starters) or f"{first} {second}" in pairs

        def split(text):
            if text is None:
                return None
            pieces = boundary.sub(rf"\1{mark}\2", text).split(mark)
            out, held = [], ""
            for piece, after in zip(pieces, chain(pieces[1:], (None,))):
                if after is not None and piece.endswith(".") and joins(piece.rsplit(None, 1)[-1], after):
                    held += piece
                    continue
                if sentence := (held + piece).strip():
                    out.append(sentence)
                held = ""
            return out

        return split


def sentences(text, model: SentenceModel) -> Column:
    """T10 with a trained model: pieces trimmed, blanks dropped, white space inside a sentence as it was."""
    split, kind = model.splitter(), pa.list_(pa.string())

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split_all(texts: pa.Array) -> pa.Array:
        return pa.array([split(t) for t in texts.to_pylist()], kind)

    return split_all(F.col(text) if isinstance(text, str) else text)
