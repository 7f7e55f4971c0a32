"""Metadata items keyed by (pk, sk).

An item is the metadata record without ``raw_html``, with ``cnr`` (any case)
moved to ``pk``, ``sk`` fixed, dates as ISO strings and the object key added.
Records without a case number cannot be written; they go to a rejects frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES — item sort key and the date columns written as ISO strings.
ITEM_SK = "HC_DOC_METADATA"
DATE_FIELDS = ("date_of_registration", "decision_date")


def iso_date(df: DataFrame, name: str) -> Column:
    """Date -> ``yyyy-MM-dd``; timestamp -> ``yyyy-MM-ddTHH:mm:ss[.ffffff]``; else as is."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        micros = F.unix_micros(c.cast("timestamp")) % 1_000_000
        base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        return F.when(micros == 0, base).otherwise(F.concat(base, F.date_format(c, ".SSSSSS")))
    return c


def has_cnr(cnr: Column) -> Column:
    """a case number is present (not null, not empty)."""
    return F.coalesce(cnr != F.lit(""), F.lit(False))


def items(records: DataFrame, key_col: str = "s3_key", cnr_col: str = "cnr",
          drop: tuple[str, ...] = ()) -> DataFrame:
    """P7 over every record: pk, sk, the other columns, ISO dates, object key."""
    cols = []
    for name in records.columns:
        if name == "raw_html" or name.lower() == cnr_col.lower() or name in drop:
            continue
        cols.append(iso_date(records, name).alias(name) if name in DATE_FIELDS else F.col(name))
    return records.select(F.col(cnr_col).alias("pk"), F.lit(ITEM_SK).alias("sk"), *cols)


def split_items(records: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) items by F3."""
    it = items(records, **kw)
    ok = has_cnr(F.col("pk"))
    return it.where(ok), it.where(~ok)
