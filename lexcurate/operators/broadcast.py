"""Size-checked broadcast: hint a join side only when its bytes are bounded."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexcurate.session import checkpoint_dir, scratch_path

DEFAULT_MAX_BROADCAST_BYTES = 128 << 20


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage of a small derived table (model, lookup) through the shared
    checkpoint folder, so a count and the later join do not compute it twice
    and a lost executor does not recompute its whole lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared scratch folder: for tables that may be large, read by column and by several plans."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` in memory: strings and nested values by their length, 8 for any other column, 16 a row."""
    width = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + 8 + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
        else:
            width = width + 8
    return int(df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0])


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` if it holds at most ``max_bytes``, else leave the
    join to a shuffle (sort-merge, with AQE skew splitting). Pass a
    materialized frame: the size is an action."""
    return F.broadcast(df) if broadcast_bytes(df) <= max_bytes else df
