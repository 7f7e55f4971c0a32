"""Partition paths, object keys, court / index names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def partition_prefix(year, court_code) -> Column:
    """``data/pdf/year=Y/court=C/``."""
    return F.concat(F.lit("data/pdf/year="), _c(year).cast("string"), F.lit("/court="),
                    _c(court_code).cast("string"), F.lit("/"))


def is_pdf(key) -> Column:
    """key ends with ``.pdf`` in any case."""
    return F.lower(_c(key)).endswith(".pdf")


def key_year(decision_date, run_year, dtype: str = "string") -> Column:
    """Year part of an object key from ``decision_date``.

    date / timestamp -> its year; string -> strict ``%Y-%m-%d`` (unpadded month
    and day accepted, as ``strptime`` does); unparseable -> the run's year;
    null or empty -> ``None``.
    """
    d = _c(decision_date)
    run = _c(run_year).cast("string")
    if dtype in ("date", "timestamp"):
        return F.coalesce(F.year(d).cast("string"), F.lit("None"))
    # what strptime takes: four digits of a year from 1 on, month and day of one or two digits
    strict = F.when(d.rlike(r"^\d{4}-(1[0-2]|0?[1-9])-\d{1,2}$"), F.year(F.try_to_date(d, "yyyy-M-d")))
    parsed = F.when(strict > 0, strict).cast("string")
    return F.when(d.isNull() | (d == ""), F.lit("None")).otherwise(F.coalesce(parsed, run))


def basename(link) -> Column:
    """Text after the last ``/`` (``os.path.basename``)."""
    return F.regexp_extract(_c(link), r"([^/]*)$", 1)


def file_name(link) -> Column:
    """File part of the key: basename, or ``None`` for a null / empty link."""
    link = _c(link)
    return F.when(link.isNull() | (link == ""), F.lit("None")).otherwise(basename(link))


def skip_link(link) -> Column:
    """link present but its basename empty -> the record is skipped, uncounted."""
    link = _c(link)
    return F.coalesce(link.isNotNull() & (link != "") & (basename(link) == ""), F.lit(False))


def object_key(year_val, court_code, bench, fname) -> Column:
    """``data/pdf/year={y}/court={c}/bench={b}/{file}``."""
    return F.concat(F.lit("data/pdf/year="), _c(year_val), F.lit("/court="), _c(court_code).cast("string"),
                    F.lit("/bench="), _c(bench).cast("string"), F.lit("/"), _c(fname))


def court_name(court) -> Column:
    """P4 (run header): spaces to ``-``; a missing court is ``unknown-court``."""
    return F.coalesce(F.replace(_c(court), F.lit(" "), F.lit("-")), F.lit("unknown-court"))


def court_path_name(court) -> Column:
    """P4 (sink paths): ``--`` to ``-`` (one left-to-right pass), then spaces to ``-``."""
    return F.replace(F.replace(court_name(court), F.lit("--"), F.lit("-")), F.lit(" "), F.lit("-"))


def index_name(court) -> Column:
    """P5: vector index of a court: ``--`` to ``-``, lower-cased."""
    return F.lower(F.replace(court_name(court), F.lit("--"), F.lit("-")))


def vector_key(cnr, chunk_id) -> Column:
    """``{cnr}_chunk_{i}`` (a null cnr prints as ``None``)."""
    return F.concat(F.coalesce(_c(cnr), F.lit("None")), F.lit("_chunk_"), _c(chunk_id).cast("string"))


def year_from_log_name(name) -> Column:
    """``processing_log_1995.jsonl`` -> ``1995`` (strip ``.jsonl``, last ``_`` part)."""
    return F.element_at(F.split(F.replace(_c(name), F.lit(".jsonl"), F.lit("")), "_"), -1)
