"""Stage-1 quality operators: score, garble gate, repair pass, status, curation gate.

F5  garble gate      (ratio < min AND language not allowed) OR blank text
F6  curation gate    doc_type = 'judgment' AND status IN (ok_no_ocr, ok_after_ocr)
F7  repair accepted  ratio_after >= min AND language_after allowed
F8  allowed set      comma list, items trimmed
J3  scored LEFT JOIN repaired text on key (garbled rows only)
T11 status           one CASE over F5, J3, F7
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.functions.classify import doc_type as classify
from lexcurate.functions.text import is_blank, word_ratio_heuristic
from lexcurate.operators.broadcast import materialize
from lexcurate.operators.langid import LANG_TYPE

DEFAULT_MIN_WORD_RATIO = 0.6
DEFAULT_ALLOWED_LANGS = "en,hi,te,mr"

# FIXED VALUES — stage-1 status strings.
OK_NO_OCR = "ok_no_ocr"
OK_AFTER_OCR = "ok_after_ocr"
STILL_GARBLED = "ocr_done_but_still_garbled"
OCR_FAILED = "ocr_failed"
DOWNLOAD_FAILED = "download_failed: "
UPLOAD_FAILED = "upload_failed: "


def parse_langs(langs: str | list[str] | set[str]) -> list[str]:
    """F8: allowed-language set from a comma list (items trimmed)."""
    if isinstance(langs, str):
        langs = langs.split(",")
    return sorted({x.strip() for x in langs})


def lang_allowed(lang: Column, allowed: list[str]) -> Column:
    """Membership that treats a null language as not allowed (never null)."""
    return F.coalesce(lang, F.lit("")).isin(*allowed) if allowed else F.lit(False)


def garbled(ratio: Column, lang: Column, blank: Column, min_ratio: float, allowed: list[str]) -> Column:
    """follows the code, not its docstring: AND of the two tests, OR blank."""
    return ((ratio < F.lit(min_ratio)) & ~lang_allowed(lang, allowed)) | blank


def repair_accepted(ratio_after: Column, lang_after: Column, min_ratio: float, allowed: list[str]) -> Column:
    """strict AND, unlike F5."""
    return (ratio_after >= F.lit(min_ratio)) & lang_allowed(lang_after, allowed)


def status(is_garbled: Column, repaired: Column, accepted: Column) -> Column:
    """T11 without the fetch / upload failures (handled by the caller)."""
    return (
        F.when(~is_garbled, F.lit(OK_NO_OCR))
        .when(~repaired, F.lit(OCR_FAILED))
        .when(accepted, F.lit(OK_AFTER_OCR))
        .otherwise(F.lit(STILL_GARBLED))
    )


def curation_gate(doc_type: Column, status_col: Column) -> Column:
    """F6."""
    return (doc_type == F.lit("judgment")) & status_col.isin(OK_NO_OCR, OK_AFTER_OCR)


def score(df: DataFrame, detector, key_col: str, text_col: str, prefix: str,
          ratio_fn=word_ratio_heuristic, extra=(), freq: DataFrame | None = None) -> DataFrame:
    """Text-free scores of each row: key, ``{prefix}word_ratio``, ``{prefix}lang``
    (struct lang, prob) and any ``extra`` text-derived columns.

    A detector that needs a model join returns (key, lang) rows, and a
    frequency-list ratio (T2, ``freq`` given) returns (key, ratio) rows; both
    are joined onto the text-free frame, so document text never enters a
    shuffle.
    """
    cols = [c for c in df.columns if c != text_col]
    out = list(extra)
    if freq is None:
        out.append(ratio_fn(F.col(text_col)).alias(f"{prefix}word_ratio"))
    if detector.inline:
        out.append(detector.column(text_col).alias(f"{prefix}lang"))
    small = df.select(*cols, *out)
    if freq is not None:
        from lexcurate.operators.frequency import word_ratio_freq

        ratios = word_ratio_freq(df.select(key_col, text_col), freq, id_col=key_col, text_col=text_col)
        small = small.join(ratios.withColumnRenamed("word_ratio", f"{prefix}word_ratio"), key_col, "left")
    if not detector.inline:
        langs = detector.languages(df.select(key_col, text_col), key_col, text_col, f"{prefix}lang")
        small = small.join(langs, key_col, "left")
    return small


def one_repair(repaired: DataFrame) -> DataFrame:
    """One row per key, so that a key with several repaired rows gets one log row."""
    rest = [c for c in repaired.columns if c != "key"]
    return repaired.groupBy("key").agg(F.max(F.struct(*rest)).alias("__r")).select("key", *[F.col(f"__r.{c}") for c in rest])


def assess(docs: DataFrame, detector, repaired: DataFrame | None = None, *,
           min_ratio: float = DEFAULT_MIN_WORD_RATIO,
           allowed_langs=DEFAULT_ALLOWED_LANGS, lexicon: str = "latin",
           fix_fused: bool = False, classify_on: str = "before",
           key_col: str = "key", text_col: str = "text",
           fetch_error_col: str | None = None, keep: tuple[str, ...] = (),
           ratio_fn=word_ratio_heuristic, restrict_repairs: bool = True,
           freq: DataFrame | None = None, upload_error_col: str | None = None) -> DataFrame:
    """E1 core: exactly one log row per input document.

    ``docs`` has ``key``, ``text`` (and optionally a fetch-error column);
    ``repaired`` has ``key``, ``text``: the repaired (OCR) text of documents
    that went through repair. Only garbled rows have use for them, so the scores are
    written out once and only the texts of garbled keys are scored
    (``restrict_repairs=False`` scores them all, for a table that is known to
    hold no others). Of several repaired rows of a key the greatest text counts. The document text never crosses a shuffle: the
    joins carry keys and scores only.
    ``classify_on="after"`` types a repaired document on its repaired text.
    ``upload_error_col``: what the curated store answered when the document was
    copied; a document that was to be copied gets the status ``upload_failed: ...``.
    ``freq`` (a frequency list, T2b) switches the word ratio to the
    known-word ratio (T2), as when the reference has its word list installed.
    """
    allowed = parse_langs(allowed_langs)
    err = F.col(fetch_error_col) if fetch_error_col else F.lit(None).cast("string")
    passthrough = [c for c in getattr(detector, "input_cols", ()) if c not in keep]
    base = docs.select(F.col(key_col).alias("key"), *keep, *passthrough, F.col(text_col).alias("__text"),
                       err.alias("__fetch_error"),
                       (F.col(upload_error_col) if upload_error_col else F.lit(None).cast("string")).alias("__upload_error"))
    small = score(base, detector, "key", "__text", "b_", ratio_fn, freq=freq, extra=(
        is_blank(F.col("__text")).alias("__blank"),
        classify(F.col("__text"), lexicon, fix_fused).alias("__doc_type"),
    ))
    small = small.withColumn(
        "__garbled", garbled(F.col("b_word_ratio"), F.col("b_lang.lang"), F.col("__blank"), min_ratio, allowed))

    if repaired is not None:
        rep = repaired.select(F.col(key_col).alias("key"), F.col(text_col).alias("__rtext"),
                              *getattr(detector, "input_cols", ()))
        if restrict_repairs:
            # the repaired table also holds texts of documents that passed the
            # gate: score only garbled keys, reading the text-free scores once
            small = materialize(small)
            need = small.where(F.col("__garbled") & F.col("__fetch_error").isNull()).select("key")
            rep = rep.join(need, "key", "left_semi")
        rep = one_repair(rep)
        rep = score(rep, detector, "key", "__rtext", "a_", ratio_fn, freq=freq, extra=(
            F.lit(True).alias("__repaired"),
            (classify(F.col("__rtext"), lexicon, fix_fused) if classify_on == "after"
             else F.lit(None).cast("string")).alias("__rdoc_type"),
        )).select("key", "a_word_ratio", "a_lang", "__repaired", "__rdoc_type")
        joined = small.join(rep, "key", "left")
    else:
        joined = small.select("*", F.lit(None).cast("double").alias("a_word_ratio"),
                              F.lit(None).cast(LANG_TYPE).alias("a_lang"),
                              F.lit(None).cast("boolean").alias("__repaired"),
                              F.lit(None).cast("string").alias("__rdoc_type"))

    repaired_ok = F.coalesce(F.col("__repaired"), F.lit(False)) & F.col("__garbled")
    accepted = repair_accepted(F.col("a_word_ratio"), F.col("a_lang.lang"), min_ratio, allowed)
    failed_fetch = F.col("__fetch_error").isNotNull()
    st = F.when(failed_fetch, F.concat(F.lit(DOWNLOAD_FAILED), F.col("__fetch_error"))) \
        .otherwise(status(F.col("__garbled"), repaired_ok, accepted))
    dt = F.col("__doc_type")
    refused = F.col("__upload_error").isNotNull()
    if classify_on == "after":
        dt = F.when(repaired_ok, F.col("__rdoc_type")).otherwise(dt)

    st = F.when(refused & curation_gate(dt, st), F.concat(F.lit(UPLOAD_FAILED), F.col("__upload_error"))).otherwise(st)

    def unless_failed(c):
        return F.when(~failed_fetch, c)

    return joined.select(
        "key", *keep,
        st.alias("status"),
        unless_failed(F.col("b_word_ratio")).alias("word_ratio_before"),
        unless_failed(F.col("b_lang")).alias("lang_before"),
        F.when(repaired_ok, F.col("a_word_ratio")).alias("word_ratio_after"),
        F.when(repaired_ok, F.col("a_lang")).alias("lang_after"),
        repaired_ok.alias("did_ocr"),
        unless_failed(dt).alias("doc_type"),
    )


def curated(log: DataFrame) -> DataFrame:
    """F6 over log rows: the documents to copy to the curated store."""
    return log.where(curation_gate(F.col("doc_type"), F.col("status")))
