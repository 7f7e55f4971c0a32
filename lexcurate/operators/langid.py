"""Language detection as Spark joins.

Model: character-trigram naive Bayes with add-one smoothing.
  * text is lower-cased, every run of non-letters becomes one space, and the
    result is padded with a space on both sides; its trigrams are all
    3-character windows.
  * profile (T3b): count(lang, gram) over a labelled corpus.
  * score(doc, lang) = sum over the doc's trigram occurrences of
    ln((count(lang, g) + 1) / (total(lang) + V)), V = distinct grams.
    Each ln term is held as a fixed-point integer (micro-units), so scores are
    exact sums, identical whatever order a cluster adds them in.
  * top-1 language by score desc, language asc; probability = softmax.

Scale: trigram occurrences are counted in the scan stage, as integers in Arrow
batches, and never cross a shuffle. The profile
(bounded by languages x distinct trigrams, size checked at plan time) is
broadcast; each distinct trigram of a document is joined in the scan stage and partially summed
per (document, language) before the only shuffle, which carries one row per
document and language.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.operators.broadcast import DEFAULT_MAX_BROADCAST_BYTES, broadcast_bytes, materialize

SCALE = 1_000_000  # fixed-point unit of log-probabilities
LANG_TYPE = "struct<lang:string,prob:double>"


def normalized(text) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    body = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " ")
    return F.concat(F.lit(" "), body, F.lit(" "))


def trigrams(text) -> Column:
    """Array of all 3-character windows of the normalized text.

    One regex pass with a capturing look-ahead yields the overlapping windows
    in O(length); ``substring`` by position would rescan UTF-8 from the start
    for every window.
    """
    return F.regexp_extract_all(normalized(text), F.lit("(?=(.{3}))"), 1)


#: Characters that are counted at once; rows of a batch that a task returns, and trigrams that it holds.
BLOCK, OUT_ROWS, HELD_GRAMS = 1 << 20, 1 << 17, 300_000
_BITS = 21  # of a code point


def _key_maker(block: int, bits: int):
    """``gram_keys`` as a function that tasks carry with them: they needn't have this package."""

    def keys(normal: str):
        for a in range(0, len(normal) - 2, block):
            c = np.frombuffer(normal[a:a + block + 2].encode("utf-32-le"), np.uint32).astype(np.int64)
            yield c[:-2] << 2 * bits | c[1:-1] << bits | c[2:]

    return keys


def gram_keys(normal: str):
    """The trigrams of a normalized text as integers of three code points, in arrays of BLOCK at most."""
    return _key_maker(BLOCK, _BITS)(normal)


def gram_key(gram: Column) -> Column:
    """The same integer of a trigram."""
    code = [F.ascii(F.substring(gram, i, 1)).cast("long") for i in (1, 2, 3)]
    return F.shiftleft(code[0], 2 * _BITS).bitwiseOR(F.shiftleft(code[1], _BITS)).bitwiseOR(code[2])


def train_profiles(corpus: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) counts. Tasks add up before the shuffle, so hot grams are a row a task."""
    texts = corpus.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), normalized(text_col).alias("text"))
    schema = f"lang {texts.schema['lang'].dataType.simpleString()}, gram string, n long"
    kind, keys_of = texts.limit(0).toArrow().schema.field("lang").type, _key_maker(BLOCK, _BITS)

    def gram(key):
        return "".join(chr(key >> i * _BITS & (1 << _BITS) - 1) for i in (2, 1, 0))

    def rows(batches):
        held, waiting = defaultdict(Counter), defaultdict(list)

        def count(lang):
            keys, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            held[lang].update(dict(zip(keys.tolist(), n.tolist())))

        def out():
            for lang in list(waiting):
                count(lang)
            for lang, grams in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), kind), pa.array([gram(k) for k in grams], pa.string()),
                                                  pa.array(grams.values(), pa.int64())], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for keys in keys_of(text):
                    waiting[lang].append(keys)
            for lang in [k for k, w in waiting.items() if sum(map(len, w)) >= BLOCK]:
                count(lang)
            if sum(map(len, held.values())) > HELD_GRAMS:
                yield from out()
        yield from out()

    return texts.mapInArrow(rows, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def gram_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __letters, __key, __c): a row a distinct trigram of a text (of a block, where it is long); one without a key for a text that has none."""
    texts = docs.select(F.col(id_col).alias("__id"), normalized(text_col).alias("__text")).select(
        "__id", F.col("__text").rlike(r"\p{L}").alias("__letters"), "__text")
    keys_of = _key_maker(BLOCK, _BITS)
    schema = f"__id {texts.schema['__id'].dataType.simpleString()}, __letters boolean, __key long, __c long"

    def rows(batches):
        for batch in batches:
            at, keys, counts = [], [], []

            def out():
                place = pa.array(np.repeat(np.array([i for i, _ in at]), [n for _, n in at]))  # noqa: B023
                key, n = np.concatenate(keys), np.concatenate(counts)  # noqa: B023
                return pa.RecordBatch.from_arrays([batch.column(0).take(place), batch.column(1).take(place),  # noqa: B023
                                                   pa.array(key, pa.int64(), mask=key < 0), pa.array(n)], names=["__id", "__letters", "__key", "__c"])

            held = 0
            for i, text in enumerate(batch.column(2).to_pylist()):
                for k, n in [np.unique(keys, return_counts=True) for keys in keys_of(text)] or [(np.array([-1]), np.array([0]))]:
                    at.append((i, len(k)))
                    keys.append(k)
                    counts.append(n.astype(np.int64))
                    held += len(k)
                    if held > OUT_ROWS:
                        yield out()
                        at, keys, counts, held = [], [], [], 0
            if at:
                yield out()

    return texts.mapInArrow(rows, schema)


def model_weights(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, gram, w) with w = round(ln(n+1)*SCALE), and (lang, base) with
    base = round(ln(total + V)*SCALE)."""
    vocab = profiles.select(F.countDistinct("gram")).scalar()  # scalar subquery
    totals = profiles.groupBy("lang").agg(F.sum("n").alias("total"))
    base = totals.select("lang", F.round(F.log(F.col("total") + vocab) * SCALE).cast("long").alias("base"))
    weights = profiles.select("lang", "gram", F.round(F.log(F.col("n") + 1) * SCALE).cast("long").alias("w"))
    return weights, base


class NaiveBayesDetector:
    """Detector backed by trained profiles (a DataFrame of lang, gram, n).

    The model is pivoted to one row per gram with one weight column per
    language, so each distinct trigram of a document joins at most one model row and the
    only aggregate is a per-document sum of a few columns. The language
    labels (one per language, a handful of strings) are read at plan time to
    name those columns, together with each language's normaliser.
    """

    inline = False

    def __init__(self, profiles: DataFrame, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                 materialize_model: bool = True):
        if materialize_model:
            profiles = materialize(profiles)  # trained once; weights and normalisers read it
        weights, base = model_weights(profiles)
        # one (label, normaliser) pair per language: model parameters, not data
        params = base.orderBy("lang").collect()
        self.langs = [r.lang for r in params]
        self.base = {r.lang: int(r.base) for r in params}
        wide = weights.groupBy("gram").pivot("lang", self.langs).agg(F.first("w"))
        wide = wide.select(gram_key(F.col("gram")).alias("__key"), *[F.coalesce(F.col(f"`{l}`"), F.lit(0)).cast("long").alias(self._c(i))
                                     for i, l in enumerate(self.langs)])
        if materialize_model:
            wide = materialize(wide)
        self.small = broadcast_bytes(wide) <= max_broadcast_bytes
        self.wide = F.broadcast(wide) if self.small else wide

    @staticmethod
    def _c(i: int) -> str:
        return f"__w{i}"

    def detect(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(id, lang, prob): top-1 language per document; (null, 0.0) without letters."""
        k = len(self.langs)
        wcols = [self._c(i) for i in range(k)]
        sums = (gram_counts(docs, id_col, text_col).join(self.wide, "__key", "left")
                .groupBy("__id").agg(F.sum("__c").alias("__n"), F.max("__letters").alias("__letters"),
                                     *[F.sum(F.coalesce(F.col(c), F.lit(0)) * F.col("__c")).alias(c) for c in wcols]))
        best = self.pick(sums, "__n", "__letters", wcols)
        return sums.select(F.col("__id").alias(id_col), best["lang"].alias("lang"), best["prob"].alias("prob"))

    def pick(self, sums: DataFrame, n_col: str, letters_col: str, weight_cols: list[str]):
        """struct(lang, prob) column from per-document weight sums (one column per language)."""
        n = F.coalesce(F.col(n_col), F.lit(0))
        scores = F.array(*[(F.coalesce(F.col(c), F.lit(0)) - n * F.lit(self.base[l]))
                           for c, l in zip(weight_cols, self.langs)])

        def best(sc):
            top = F.array_max(sc)
            pos = F.array_position(sc, top)  # first maximum: languages are in ascending order
            z = F.aggregate(sc, F.lit(0.0), lambda acc, x: acc + F.exp((x - top) / F.lit(float(SCALE))))
            return F.struct(F.element_at(F.array(*[F.lit(l) for l in self.langs]), pos.cast("int")).alias("lang"),
                            (F.lit(1.0) / z).alias("prob"))

        b = F.element_at(F.transform(F.array(scores), best), 1)
        letters = F.coalesce(F.col(letters_col), F.lit(False))
        return F.struct(F.when(letters, b["lang"]).alias("lang"),
                        F.when(letters, b["prob"]).otherwise(F.lit(0.0)).alias("prob"))

    def languages(self, docs: DataFrame, id_col: str, text_col: str, out_col: str) -> DataFrame:
        """(id, out_col struct<lang, prob>), to be joined onto a text-free frame."""
        det = self.detect(docs, id_col, text_col)
        return det.select(id_col, F.struct("lang", "prob").alias(out_col))


class GivenLanguage:
    """Detector stand-in that reads the language from a column of the input."""

    inline = True

    def __init__(self, lang_col: str = "lang", prob: float = 1.0):
        self.lang_col = lang_col
        self.prob = prob
        self.input_cols = (lang_col,)

    def column(self, text_col: str) -> Column:
        """struct<lang, prob> from the given column; (null, 0.0) for blank text."""
        from lexcurate.functions.text import is_blank

        blank = is_blank(F.col(text_col))
        lang = F.when(blank, F.lit(None).cast("string")).otherwise(F.col(self.lang_col))
        prob = F.when(blank | F.col(self.lang_col).isNull(), F.lit(0.0)).otherwise(F.lit(self.prob))
        return F.struct(lang.alias("lang"), prob.alias("prob"))
