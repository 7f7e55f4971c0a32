"""Keyed last-write-wins upsert without a table format.

``latest`` picks one row per key with an aggregate, ``max_by`` over an
ordering struct, instead of ``row_number`` over a window: an aggregate is
combined map-side, so a hot key (one case number holding a third of all rows)
is reduced inside every task before the shuffle and never lands whole on
one task.

``upsert_table`` keeps a table in units: a partition (a vector index) and a bucket of the
hashed key. A version is a manifest, one row a unit, naming the version whose files hold it. A
batch rewrites the units that hold one of its keys and takes the others over by name, so
a small batch costs its units, not the table; versions before stay readable, and a version that is written again gives
the same files. A later batch always replaces what an earlier one wrote under a key, whatever dates
its rows bear; the order columns decide inside one batch.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexcurate.operators.lookup import heavy_keys


def upsert_date(decision_date: Column) -> Column:
    """Ordering date of a record for last-write-wins: parsed decision date (a timestamp's day), lowest when absent."""
    day = F.regexp_replace(decision_date.cast("string"), r"[T ]\d{2}:\d{2}:\d{2}(\.\d+)?$", "")
    return F.coalesce(F.try_to_date(day, "yyyy-M-d"),
                      F.lit("0001-01-01").cast("date"))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple (nulls lowest; exact ties by a hash of the row)."""
    payload = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order], F.xxhash64(*payload) if payload else F.lit(0))
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), ordering).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in payload]))


#: Rows of a unit for which a new table's buckets are counted, and the least and most buckets of a partition.
UNIT_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 500_000, 8, 4096
BUCKET, VERSION = "upsert_bucket", "__version"
#: What Spark escapes in the name of a partition folder (fixed value).
ESCAPED = re.compile(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]""")


def upsert_table(spark, new: DataFrame, path: str, version: str, keys: list[str], order: list[str],
                 partition_by: list[str] | None = None, current_version: str | None = None, buckets: int | None = None) -> str:
    """Merges ``new`` (best a written table: it is read for its keys, then whole) into version ``current_version`` of the table at ``path`` and writes ``version``; returns the path of
    its manifest, which ``read_table`` reads. ``buckets`` a partition: those of the current version, else from the rows."""
    unit, path = [*(partition_by or []), BUCKET], path.rstrip("/")
    before = manifest(spark, f"{path}/v={current_version}") if current_version is not None else None
    units = {tuple(r[c] for c in unit): r[VERSION] for r in before.select(*unit, VERSION).collect()} if before else {}  # a row a unit
    shape = before.select("__buckets", "__schema").first() if before else None
    total = new.count()
    n = shape["__buckets"] if shape else buckets or min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-total // UNIT_ROWS)))
    # no folder has an empty name
    new = new.withColumns({c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("None")) for c in partition_by or []})
    new = new.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
    touched = [tuple(r) for r in new.select(*unit).distinct().collect()]
    held = [(u, units[u]) for u in touched if u in units]
    old = _read_units(spark, path, T.StructType.fromJson(json.loads(shape["__schema"])), unit, held) if held else None
    merged = new.withColumn("__batch", F.lit(1))
    if old is not None:
        merged = old.withColumn("__batch", F.lit(0)).unionByName(merged, allowMissingColumns=True)
    # a key of very many rows is reduced in their tasks first; then units are spread whole and merged where they lie
    heavy = heavy_keys(new, keys, total)
    if not heavy.isEmpty():
        heavy = F.broadcast(heavy.select(*keys))  # two a reducer at most
        many = latest(merged.join(heavy, keys, "left_semi"), [*unit, *[k for k in keys if k not in unit], "__batch"], order)
        merged = merged.join(heavy, keys, "left_anti").unionByName(many)
    merged = latest(merged.repartition(*unit), [*unit, *[k for k in keys if k not in unit]], ["__batch", *order]).drop("__batch")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*unit).parquet(f"{path}/files/upsert_version={_folder(version)}")
    columns = merged.drop(BUCKET).schema
    if shape:
        was = T.StructType.fromJson(json.loads(shape["__schema"]))
        columns = T.StructType(columns.fields + [f for f in was.fields if f.name not in columns.names])
    rows = [(*u, v, n, columns.json()) for u, v in sorted((units | {u: version for u in touched}).items(), key=str)]
    schema = ", ".join([*(f"`{c}` string" for c in unit[:-1]), f"{BUCKET} int", f"{VERSION} string", "__buckets int", "__schema string"])
    (spark.createDataFrame(rows or [(*[None] * (len(unit) + 1), n, columns.json())], schema).coalesce(1)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/v={version}"))
    return f"{path}/v={version}"


def _folder(value) -> str:
    return ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", str(value))


def manifest(spark, version_path: str) -> DataFrame:
    """One row a unit: partition, bucket, version of its files, buckets a partition, columns. An empty table has one row without a unit."""
    return spark.read.parquet(version_path)


def _read_units(spark, path: str, columns: T.StructType, unit: list[str], held: list[tuple]) -> DataFrame:
    """The rows of units, each from the files of the version that the manifest names."""
    names = [f"{path}/files/upsert_version={_folder(v)}/" + "/".join(f"{c}={_folder(x)}" for c, x in zip(unit, u)) for u, v in held]
    schema = T.StructType(columns.fields + [T.StructField("upsert_version", T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    return spark.read.option("basePath", f"{path}/files").schema(schema).parquet(*names).drop("upsert_version")


def read_table(spark, version_path: str) -> DataFrame:
    """The rows of one version."""
    rows = manifest(spark, version_path)
    unit = [c for c in rows.columns if c not in (VERSION, "__buckets", "__schema")]
    units = [(tuple(r[c] for c in unit), r[VERSION]) for r in rows.where(F.col(VERSION).isNotNull()).collect()]
    columns = T.StructType.fromJson(json.loads(rows.select("__schema").first()[0]))
    if not units:
        return spark.createDataFrame([], columns)
    return _read_units(spark, version_path.rstrip("/").rsplit("/", 1)[0], columns, unit, units).drop(BUCKET).select(*columns.names)
