"""Scans of the document store, metadata, page rows and log files.

Partitioned stores are read with their Hive-style partition columns
(``year=``, ``court=``, ``bench=``) kept as strings, so a partition filter
prunes directories at planning time instead of listing keys under a prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexcurate.functions.keys import year_from_log_name
from lexcurate.operators.broadcast import broadcast_if_small, materialize
from lexcurate.sources.metadata import FILE, read_metadata

#: Objects above this size (what an array of bytes can hold) are not read into a row; they become a fetch error of their own document.
MAX_OBJECT_BYTES = (1 << 31) - (1 << 20)


def _where_partitions(df: DataFrame, **eq) -> DataFrame:
    for k, v in eq.items():
        if v is None:
            continue
        if isinstance(v, (list, tuple, set)):
            df = df.where(F.col(k).isin(*[str(x) for x in v]))
        else:
            df = df.where(F.col(k) == F.lit(str(v)))
    return df


def pdf_objects(spark: SparkSession, root: str, year=None, court=None, bench=None,
                year_range: tuple[int, int] | None = None, with_content: bool = True,
                max_bytes: int = MAX_OBJECT_BYTES) -> DataFrame:
    """S1 + S2 + F1: PDF objects under a partitioned root, with bytes when asked.

    ``pathGlobFilter`` applies the case-insensitive ``.pdf`` test at listing
    time; partition filters prune directories. (``recursiveFileLookup`` would
    drop the partition columns, so it is not used.) A year range leaves out
    partitions whose year is no number (``None``). With content, an object of
    more than ``max_bytes`` has null content and a ``fetch_error`` instead of
    failing the job.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(root))
    df = _where_partitions(df, year=year, court=court, bench=bench)
    if year_range is not None:
        lo, hi = year_range
        df = df.where(F.col("year").try_cast("int").between(lo, hi))
    cols = ["path", "year", "court"] + (["bench"] if "bench" in df.columns else []) + ["length"]
    if not with_content:
        return df.select(*cols)
    # the length filter reaches the source: a larger object is listed, its bytes are not read
    read = df.where(F.col("length") <= max_bytes).select(*cols, "content", F.lit(None).cast("string").alias("fetch_error"))
    large = df.select(*cols).where(F.col("length") > max_bytes).select(
        *cols, F.lit(None).cast("binary").alias("content"), F.format_string("object of %d bytes is too large", "length").alias("fetch_error"))
    return read.unionByName(large)


def metadata_partitions(spark: SparkSession, root: str, year=None, court_code=None, bench=None,
                        year_range: tuple[int, int] | None = None, file_glob: str | None = "*metadata.parquet",
                        court_dir: str = "court") -> DataFrame:
    """S3: metadata Parquet of one or many (year, court, bench) partitions.

    The record files hold a ``court`` column (the court's name) while the
    path holds ``court=`` (its code), so partition inference would collide.
    The requested partition directories are globbed instead (exact values,
    no prefix match; a year range becomes a brace list, so only those
    directories are listed) and the run keys are taken from each file's
    path. Only files named ``...metadata.parquet`` are records (``file_glob=None``
    takes all). A column that some files lack is null there; one that they type
    differently is a string (``sources.metadata``). A file that can't be read is an
    error here; ``plans.jobs.run_years`` goes on without it. Column pruning means ``raw_html`` is never read unless selected.
    """
    scan = read_metadata(spark, root, year=year, court_code=court_code, bench=bench, year_range=year_range,
                         file_glob=file_glob, court_dir=court_dir, skip=())
    broken = scan.unreadable.take(5)
    if broken:
        raise ValueError("unreadable metadata files: " + "; ".join(f"{r[FILE]}: {r.error}" for r in broken))
    if scan.records is None:
        raise ValueError(f"no metadata files under {root}")
    return scan.records.drop(FILE)


def assemble_pages(pages: DataFrame, key_col: str = "doc_key", page_col: str = "page_no",
                   text_col: str = "text", sep: str = "\n", drop_empty: bool = True) -> DataFrame:
    """Document text from page rows, pages in page order.

    ``sep="\\n", drop_empty=True``: empty / null pages are dropped, the rest
    joined by newlines (stage-1 extractor); a document of empty pages only has
    empty text. ``sep="", drop_empty=False``: null pages count as empty
    strings, no separator (stage-2 extractor).

    The grouping holds (page_no, text) of one document only, so a group is
    bounded by the pages of one document; documents are distributed by key.
    """
    page = F.struct(F.col(page_col).alias("p"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = pages.select(F.col(key_col).alias("__k"), page.alias("__pg"))
    agg = rows.groupBy("__k").agg(F.array_sort(F.collect_list("__pg")).alias("__pages"))
    texts = F.transform("__pages", lambda x: x["t"])
    if drop_empty:
        texts = F.filter(texts, lambda t: t != "")
    return agg.select(F.col("__k").alias(key_col), F.array_join(texts, sep).alias("text"))


# FIXED VALUES — the stage-1 log record layout.
LOG_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("word_ratio_before", T.DoubleType()),
    T.StructField("lang_before", T.ArrayType(T.StringType())),
    T.StructField("word_ratio_after", T.DoubleType()),
    T.StructField("lang_after", T.ArrayType(T.StringType())),
    T.StructField("did_ocr", T.BooleanType()),
    T.StructField("doc_type", T.StringType()),
])
# one flat JSON object: strings and anything but braces; possessive, so long strings need no stack
_FLAT_OBJECT = r'\{(?:[^{}"]++|"(?:[^"\\]++|\\.)*+")*+\}'


def _lang_struct(c: str):
    return F.when(F.col(c).isNotNull(), F.struct(
        F.col(c)[0].alias("lang"), F.col(c)[1].cast("double").alias("prob")))


# from one opening brace to the next; strings keep theirs, and a quote that nothing closes stands for itself
_PIECE = r'\{?(?:[^{"]++|"(?:[^"\\]++|\\.)*+"|")++|\{'
_CLOSED = r'^(?:[^}"]++|"(?:[^"\\]++|\\.)*+"|")*+\}'


def log_lines(spark: SparkSession, path_glob: str) -> DataFrame:
    """Every non-blank piece of the log files: file_path, line, r (the record, null where it is none).

    A line that holds a record stands for itself, whatever the file's other lines
    hold. Only in files in which no line is a record (pretty-printed ones)
    lines are put together again: a record runs from one opening brace to its closing one. Which record a line
    belongs to is a running count of opening braces, a prefix sum over the file's splits: each split is
    counted where it lies, one row a split tells the next ones what went before, and only the lines of one record are
    gathered. A string can't run over a line in JSON, so no other state passes from line to line.
    """
    schema = T.StructType(LOG_SCHEMA.fields + [T.StructField("bad", T.StringType())])
    parsed = lambda line: F.from_json(line, schema, {"columnNameOfCorruptRecord": "bad"})
    sound = lambda r: F.when(r["bad"].isNull() & r["key"].isNotNull(), r)
    lines = spark.read.text(path_glob).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), F.col("value").alias("line")).where(F.trim("line") != "")
    lines = lines.withColumn("r", sound(parsed(F.col("line"))))
    by_line = lines.groupBy("file_path").agg(F.max(F.col("r").isNotNull()).alias("by_line"))
    lines = lines.join(broadcast_if_small(materialize(by_line)), "file_path")  # a row a file

    pieces = lines.where(~F.col("by_line")).select(
        "file_path", "block", "n", F.posexplode(F.regexp_extract_all("line", F.lit(_PIECE), 0)).alias("i", "line"))
    opens, closes = F.col("line").startswith("{"), F.col("line").rlike(_CLOSED)
    # what a piece leaves behind: an open record, or none; a piece in between leaves it as it was
    pieces = pieces.withColumn("opens", opens.cast("long")).withColumn("leaves", F.when(closes, 0).when(opens, 1))
    splits = pieces.groupBy("file_path", "block").agg(
        F.sum("opens").alias("opened"), F.max_by("leaves", F.when(F.col("leaves").isNotNull(), F.struct("n", "i"))).alias("left"))
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file_path", "block", F.coalesce(F.sum("opened").over(before), F.lit(0)).alias("opened"),
                           F.last("left", ignorenulls=True).over(before).alias("left"))
    here = Window.partitionBy("file_path", "block").orderBy("n", "i")
    pieces = pieces.join(splits, ["file_path", "block"]).withColumns({
        "record": F.col("opened") + F.sum("opens").over(here),
        "inside": F.coalesce(F.last("leaves", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.col("left"), F.lit(0)) == 1})
    part_of = F.col("inside") | (F.col("opens") == 1)
    whole = (pieces.where(part_of).groupBy("file_path", "record")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "n", "i", "line"))), lambda x: x["line"]), "\n").alias("text")))
    found = F.regexp_extract("text", _FLAT_OBJECT, 0)
    objects = whole.select("file_path", F.when(found != "", found).otherwise(F.col("text")).alias("line"))
    stray = pieces.where(~part_of & F.col("line").rlike(r"[^\s,\[\]]")).select("file_path", "line")  # more than what separates records
    objects = objects.unionByName(stray).withColumn("r", sound(parsed(F.col("line"))))
    return lines.where("by_line").select("file_path", "line", "r").unionByName(objects)


def read_logs(spark: SparkSession, path_glob: str) -> DataFrame:
    """S6 + P9: stage-1 log records, one per line or pretty-printed.

    The year is that of a ``year=`` folder, or else comes from the file name.
    What isn't a record is in ``log_rejects``.
    """
    rows = log_lines(spark, path_glob).where("r IS NOT NULL").select("file_path", "r.*").drop("bad")
    name = F.element_at(F.split(F.col("file_path"), "/"), -1)
    folder = F.regexp_extract("file_path", r"/year=([^/]+)/", 1)
    return rows.select(
        "key", "status", "word_ratio_before", _lang_struct("lang_before").alias("lang_before"),
        "word_ratio_after", _lang_struct("lang_after").alias("lang_after"), "did_ocr", "doc_type",
        "file_path", name.alias("file_name"), F.when(folder != "", folder).otherwise(year_from_log_name(name)).alias("log_year"),
    )


def log_rejects(spark: SparkSession, path_glob: str) -> DataFrame:
    """The lines (of pretty-printed files: objects) that are no log record: file_name, line."""
    return log_lines(spark, path_glob).where("r IS NULL").select(
        F.element_at(F.split(F.col("file_path"), "/"), -1).alias("file_name"), "line")
