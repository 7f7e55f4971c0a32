"""S3 + M2: metadata partitions whose files differ in schema, or can't be read.

Writers of different years type the same column differently (``decision_date`` as
date, timestamp or string), lack columns, or leave a broken file behind. The
footers of all files are merged in one distributed inference; only where that fails is
the list of files halved, so equal years stay together and a broken file ends up
alone, as a row of ``unreadable``. Files whose schemas agree share one scan, and the scans
are cast to one record: a column that all type alike keeps its type, one that
they don't is a string, dates and timestamps in the ISO form that items have. The year
of a typed ``decision_date`` is kept beside it (``DECISION_YEAR``), as the object key takes it from
the date itself, not from its text.

A file whose footer is sound and whose pages are not loses its rows while it is read, which
``short_files`` finds by comparing the rows that came with those its footer names.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexcurate.operators.metadata import iso_date
from lexcurate.sources import files

#: Year of a date or timestamp ``decision_date`` ("None" where it is null); null where the column is text.
DECISION_YEAR = "__decision_year"
FILE, ERROR = "__file", "error"
RUN_KEYS = ("year", "court_code", "bench")
#: Halves of the file list whose footers are inferred at the same time.
INFERENCES_AT_ONCE = 8


@dataclass
class MetadataScan:
    records: DataFrame | None  # canonical records with run keys, DECISION_YEAR and FILE; None where no file can be read
    unreadable: DataFrame      # FILE, run keys, error
    files: list[str]           # those that records come from


def one_of(v) -> str:
    """Glob of one, several or any value of a partition column."""
    if v is None:
        return "*"
    vals = [str(x) for x in (v if isinstance(v, (list, tuple, set)) else [v])]
    return vals[0] if len(vals) == 1 else "{" + ",".join(vals) + "}"


def partition_glob(root: str, year=None, court_code=None, bench=None, year_range: tuple[int, int] | None = None,
                   court_dir: str = "court") -> str:
    years = [str(y) for y in range(year_range[0], year_range[1] + 1)] if year_range else year
    return f"{root.rstrip('/')}/year={one_of(years)}/{court_dir}={one_of(court_code)}/bench={one_of(bench)}"


def run_keys(path: Column, court_dir: str) -> list[Column]:
    return [F.regexp_extract(path, rf"/{folder}=([^/]+)/", 1).alias(name)
            for folder, name in (("year", "year"), (court_dir, "court_code"), ("bench", "bench"))]


def partition_of(path: str, court_dir: str = "court") -> tuple[str, str, str]:
    """(year, court_code, bench) in a file's path."""
    folders = dict(part.split("=", 1) for part in path.split("/") if "=" in part)
    return folders["year"], folders[court_dir], folders["bench"]


def list_files(spark: SparkSession, glob: str, file_glob: str | None) -> list[str]:
    """Paths of the metadata files, empty ones too (a scan wouldn't list them)."""
    found = files.glob(spark, f"{glob}/{file_glob or '*'}", files_only=True)
    return [f for f in found if not f.rsplit("/", 1)[-1].startswith(("_", "."))]


def reason(e: Exception) -> str:
    """First line of an error, without the file's own path."""
    return (e.getCondition() or "" if isinstance(e, PySparkException) else "") or str(e).strip().split("\n")[0][:200]


def schemas(spark: SparkSession, paths: list[str]) -> tuple[list[tuple[T.StructType, list[str]]], list[tuple[str, str]]]:
    """(groups of files with the schema that merges them, files without a readable footer with the error)."""
    groups, broken, todo = [], [], [paths] if paths else []

    def infer(some: list[str]):
        try:
            return some, spark.read.option("mergeSchema", "true").parquet(*some).schema, None
        except Exception as e:  # schemas that don't merge, or a file that isn't Parquet: told apart by halving
            return some, None, reason(e)

    with ThreadPoolExecutor(INFERENCES_AT_ONCE) as pool:
        while todo:
            results, todo = list(pool.map(infer, todo)), []
            for some, schema, error in results:
                if schema is not None:
                    groups.append((schema, some))
                elif len(some) == 1:
                    broken.append((some[0], error))
                else:
                    todo += [some[:len(some) // 2], some[len(some) // 2:]]
    return groups, broken


def scans(groups: list[tuple[T.StructType, list[str]]]) -> list[tuple[dict[str, T.DataType], list[str]]]:
    """As few scans as there are ways in which the types differ: groups share one while no column has two types."""
    out: list[tuple[dict[str, T.DataType], list[str]]] = []
    for schema, paths in sorted(groups, key=lambda g: g[1][0]):
        types = {f.name: f.dataType for f in schema.fields}
        for held, files in out:
            if all(held.get(c, t) == t for c, t in types.items()):
                held.update(types)
                files += paths
                break
        else:
            out.append((types, list(paths)))
    return out


def as_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.col(f"`{name}`"))
    if isinstance(kind, T.BinaryType):
        return F.base64(F.col(f"`{name}`"))
    return iso_date(df, name).cast("string")


def decision_year(df: DataFrame) -> Column:
    kind = df.schema["decision_date"].dataType if "decision_date" in df.columns else T.StringType()
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(F.year("decision_date").cast("string"), F.lit("None"))
    return F.lit(None).cast("string")


def read_metadata(spark: SparkSession, root: str, *, year=None, court_code=None, bench=None,
                  year_range: tuple[int, int] | None = None, file_glob: str | None = "*metadata.parquet",
                  court_dir: str = "court", skip: tuple[str, ...] = ("raw_html",), paths: list[str] | None = None) -> MetadataScan:
    """Canonical records of the selected partitions' files. ``paths``: those to read, if the caller has listed them."""
    paths = paths if paths is not None else list_files(spark, partition_glob(root, year, court_code, bench, year_range, court_dir), file_glob)
    groups, broken = schemas(spark, paths)
    # a record's own column named like a run key gives way to the path's
    groups = [(T.StructType([f for f in s.fields if f.name not in skip and f.name.lower() not in RUN_KEYS]), p) for s, p in groups]
    found = scans(groups)
    names = list(dict.fromkeys(c for types, _ in found for c in types))
    kinds = {c: [types[c] for types, _ in found if c in types] for c in names}
    mixed = {c for c in names if any(k != kinds[c][0] for k in kinds[c])}
    frames = []
    for types, some in found:
        schema = T.StructType([T.StructField(c, t) for c, t in types.items()])
        df = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*some)
        path = F.col("_metadata.file_path")
        cols = [(F.lit(None).cast("string" if c in mixed else kinds[c][0]) if c not in types
                 else as_text(df, c) if c in mixed else F.col(f"`{c}`")).alias(c) for c in names]
        frames.append(df.select(*cols, *([decision_year(df).alias(DECISION_YEAR)] if "decision_date" in mixed else []),
                                *run_keys(path, court_dir), path.alias(FILE)))
    records = reduce(DataFrame.unionByName, frames) if frames else None
    return MetadataScan(records, file_errors(spark, broken, court_dir), [f for _, some in found for f in some])


def file_errors(spark: SparkSession, broken: list[tuple[str, str]], court_dir: str) -> DataFrame:
    rows = spark.createDataFrame(broken, f"{FILE} string, {ERROR} string")
    return rows.select(FILE, *run_keys(F.col(FILE), court_dir), ERROR)


def short_files(spark: SparkSession, records: DataFrame, paths: list[str], court_dir: str = "court") -> DataFrame:
    """Those of ``paths`` of which fewer rows came than their footers name. ``records``: the rows read (a written table)."""
    if not paths:
        return file_errors(spark, [], court_dir)
    came = records.groupBy(FILE).agg(F.count(F.lit(1)).alias("came"))
    named = spark.read.schema("__none string").parquet(*paths).select(F.col("_metadata.file_path").alias(FILE)) \
        .groupBy(FILE).agg(F.count(F.lit(1)).alias("named"))  # no column: footers alone are read
    short = named.join(came, FILE, "left").where(F.coalesce("came", F.lit(0)) < F.col("named"))
    message = F.format_string("%d of %d rows can be read", F.coalesce("came", F.lit(0)), F.col("named"))
    return short.select(FILE, *run_keys(F.col(FILE), court_dir), message.alias(ERROR))
