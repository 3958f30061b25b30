"""File discovery: list a landing folder and parse listing file names.

The catalog is a DataFrame ``(path, file_name, retailer, file_date,
file_time, status)``. Listing uses Spark's own file index through the
``binaryFile`` source with only metadata columns selected, so file contents
are never read and the listing runs in parallel for large folders.

A file name is ``<source>_weekly_<yyyyMMdd>_<HHmmss>.parquet``; the source
names are a parameter. Entries may be single parquet files or folders of
part files (what Spark itself writes); for a folder the entry name is the
folder's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import col

# --- fixed values: the reference's three listing sources --------------------
DEFAULT_SOURCES = ["cubesmart", "smartstopselfstorage", "storagemart"]
# characters of ``_weekly_<8 digits>_<6 digits>.parquet``
_TAIL = 31


def name_pattern(sources: list[str]) -> str:
    """Anchored file-name regex; groups: source, date, time.

    Fixed value: the name format ``<source>_weekly_<8 digits>_<6 digits>.parquet``.
    """
    alts = "|".join(sorted(sources))
    return rf"^({alts})_weekly_(\d{{8}})_(\d{{6}})\.parquet$"


def basename(path: Column) -> Column:
    """Last path component (``os.path.basename``)."""
    return F.substring_index(path, "/", -1)


def parse_names(df: DataFrame, sources: list[str], path_col: str = "path") -> DataFrame:
    """Add ``file_name, retailer, file_date, file_time, status`` to a path list.

    status: ``ok``; ``no_match`` (unknown source, bad ending, missing time);
    ``bad_date`` (matches but the date does not exist; left out, counted).
    """
    name = basename(F.col(path_col))
    # the part behind the source has a fixed length, so the name is cut by position and one short
    # pattern tests it (the format of name_pattern)
    tail = F.right(name, F.lit(_TAIL))
    source = F.substring(name, F.lit(1), F.length(name) - _TAIL)
    named = df.select("*", name.alias("_name"), tail.alias("_tail"),
                      (source.isin(list(sources)) & tail.rlike(r"^_weekly_[0-9]{8}_[0-9]{6}\.parquet$")).alias("_match"))
    matched = F.col("_match")
    # eight digits by now, so the cast is all the parsing there is; there is no year 0
    year = F.substring("_tail", 9, 4)
    file_date = F.when(year != "0000", F.concat_ws("-", year, F.substring("_tail", 13, 2), F.substring("_tail", 15, 2))
                       .try_cast("date"))
    parsed = F.struct(
        F.col(path_col).alias("path"),
        F.col("_name").alias("file_name"),
        F.when(matched, F.expr(f"left(_name, length(_name) - {_TAIL})")).alias("retailer"),
        F.when(matched, file_date).alias("file_date"),
        F.when(matched, F.substring("_tail", 18, 6)).alias("file_time"),
        F.when(~matched, F.lit("no_match"))
         .when(file_date.isNull(), F.lit("bad_date"))
         .otherwise(F.lit("ok")).alias("status"))
    others = [c for c in df.columns if c != path_col]
    # a generator, so that filters on the result do not parse every name again
    out = named.select(*[col(c) for c in others], F.inline(F.array(parsed)))
    return out.select("path", "file_name", "retailer", "file_date", "file_time", "status", *[col(c) for c in others])


def list_files(spark: SparkSession, input_dir: str) -> DataFrame:
    """Every parquet file below ``input_dir``, at any depth: ``path`` (the top-level entry that holds it,
    a file or a folder of part files), ``leaf`` (the file), ``modified``, ``bytes``."""
    root = input_dir.rstrip("/")
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet")
             .load(root)
             .select("path", "modificationTime", "length"))
    # path of the first component below root: a file, or the folder holding part files
    below = below_root(F.col("path"), root_path(spark, root))
    entry = F.expr("left(path, length(path) - length(below) + length(first))")
    files = (files.withColumn("below", below).withColumn("first", F.substring_index("below", "/", 1)))
    return files.select(F.when(F.col("first") != "", entry).otherwise(F.col("path")).alias("path"),
                        F.col("path").alias("leaf"), F.col("modificationTime").alias("modified"),
                        F.col("length").alias("bytes"))


def list_entries(spark: SparkSession, input_dir: str) -> DataFrame:
    """Top-level entries of ``input_dir`` that hold parquet data (file or folder)."""
    return (list_files(spark, input_dir).groupBy("path")
            .agg(F.max("modified").alias("modified"), F.sum("bytes").alias("bytes"),
                 F.count(F.lit(1)).alias("parts")))


def entry_files(spark: SparkSession, input_dir: str, entries: DataFrame) -> DataFrame:
    """The files (see :func:`list_files`) of ``entries`` (``path``, ``file_name``), with their ``file_name``."""
    named = entries.select("path", "file_name")
    return list_files(spark, input_dir).join(named, "path").select("file_name", "path", "leaf", "bytes")


def root_path(spark: SparkSession, root: str) -> str:
    """The path of ``root`` as its file system resolves it, without scheme and host."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath().rstrip("/")


def below_root(path: Column, root: str) -> Column:
    """What follows ``root`` (see :func:`root_path`) in an unencoded path; empty if it is elsewhere."""
    bare = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.when(bare.startswith(root + "/"), F.substring(bare, len(root) + 2, 1 << 30)).otherwise("")


def read_catalog(spark: SparkSession, input_dir: str, sources: list[str] | None = None) -> DataFrame:
    return parse_names(list_entries(spark, input_dir), sources or DEFAULT_SOURCES)
