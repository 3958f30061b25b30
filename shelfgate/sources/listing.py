"""Listing scans: schemas of files from all their parts (footers read on the
executors) and one scan per part schema, with the file name as lineage.

Files whose columns differ in type (text prices vs double prices) cannot be
read by one parquet scan: ``mergeSchema`` refuses to merge string with
double, and a forced schema fails at read time. So files are grouped by
their ordered ``(name, type)`` list first. A file may be a folder of parts
that differ too: every part's footer is read, the file's schema is what its
parts have together (:func:`file_schemas`), and within a schema group the
parts are routed by their own columns, each kind to a scan of its own that
is brought to the group's columns.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import nanos_to_timestamp_ntz
from ..functions.schema import SOURCE_FILE, col, merged_type
from .catalog import below_root, root_path

_PART_ROW = "file_name string, leaf string, digest string, ordinal int, column string, type string"
# type name of a parquet TIMESTAMP(NANOS) column, which Spark reads only as a long
NANOS = "timestamp_ns"
# footers read by one task
FOOTERS_PER_TASK = 16
# marker columns of a file that cannot be read, and of one whose parts do not go together (``type`` says why)
UNREADABLE = "<unreadable>"
CONFLICT = "<conflict>"
# files whose schemas the driver asks Spark for at a time
FALLBACK_THREADS = 8
_READ = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}


def _footer_rows(batches):
    """mapInPandas body: read each part's parquet footer (no data pages)."""
    import hashlib

    import pandas as pd
    import pyarrow as pa
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    for pdf in batches:
        out = []
        for name, path in zip(pdf["file_name"], pdf["leaf"]):
            uri = path if "://" in path else "file://" + path.removeprefix("file:")
            try:
                fs, inner = pafs.FileSystem.from_uri(uri)
                with fs.open_input_file(inner) as f:
                    schema = pq.read_metadata(f).schema.to_arrow_schema()
                    if not len(schema):
                        raise ValueError("no columns")
                    # the footer holds offsets, sizes, counts and statistics: what tells contents apart
                    f.seek(f.size() - 8)
                    length = int.from_bytes(f.read(4), "little")
                    f.seek(f.size() - 8 - length)
                    digest = hashlib.sha256(f.read(length)).hexdigest()
            except Exception as exc:  # noqa: BLE001 - an unreadable file is reported, not fatal
                out.append((name, path, None, 0, UNREADABLE, f"{type(exc).__name__}: {exc}"))
                continue
            for i, field in enumerate(schema):
                try:
                    if pa.types.is_timestamp(field.type) and field.type.unit == "ns":
                        t = NANOS
                    else:
                        t = from_arrow_type(field.type).simpleString()
                except Exception:  # noqa: BLE001 - unknown arrow type: keep its own name
                    t = str(field.type)
                out.append((name, path, digest, i + 1, field.name, t))
        yield pd.DataFrame(out, columns=["file_name", "leaf", "digest", "ordinal", "column", "type"])


def part_schemas(files: DataFrame) -> DataFrame:
    """Schema rows of every part: ``(file_name, leaf, digest, ordinal, column, type)``.

    ``files`` needs ``file_name`` (of the entry) and ``leaf`` (a part). Footers are read by the
    executors, ``FOOTERS_PER_TASK`` parts a task on average. ``digest`` is that of the footer.
    """
    parts = -(-files.count() // FOOTERS_PER_TASK)
    return files.select("file_name", "leaf").repartition(max(1, parts)).mapInPandas(_footer_rows, _PART_ROW)


def with_spark_fallback(spark: SparkSession, parts: DataFrame, files: DataFrame) -> DataFrame:
    """Files with a footer the executors could not open are asked once more through Spark's own
    reader, which uses the cluster's file-system settings (pyarrow may lack them, e.g. for S3 or HDFS).

    One Spark job per such file reads the footers of all its parts and merges them; only if they do
    not merge are its parts asked one by one. Files that Spark cannot read either stay unreadable.
    The driver sees the names of these files. ``files`` has ``file_name``, ``path``, ``leaf``.
    """
    failed = (parts.where(F.col("column") == UNREADABLE).groupBy("file_name").agg(F.min("type").alias("error"))
              .join(files.groupBy("file_name").agg(F.min("path").alias("path")), "file_name")
              .select("file_name", "path", "error").collect())
    if not failed:
        return parts

    def columns(path: str, **options) -> list[tuple[str, str]]:
        reader = spark.read.options(**_READ, **options)
        return [(f.name, f.dataType.simpleString()) for f in reader.parquet(path).schema.fields]

    def asked(r):
        name = r["file_name"]
        try:
            try:
                found = {None: columns(r["path"], mergeSchema="true")}
            except Exception:  # noqa: BLE001 - parts that do not merge are asked one by one
                leaves = [x["leaf"] for x in files.where(F.col("file_name") == name).select("leaf").collect()]
                found = {leaf: columns(leaf) for leaf in leaves}
            return [(name, leaf, None, i + 1, c, t) for leaf, cols in found.items() for i, (c, t) in enumerate(cols)]
        except Exception:  # noqa: BLE001 - still unreadable: keep the executor's error
            return [(name, None, None, 0, UNREADABLE, r["error"])]

    with ThreadPoolExecutor(FALLBACK_THREADS) as pool:
        rows = [x for found in pool.map(asked, failed) for x in found]
    fixed = spark.createDataFrame(rows, _PART_ROW)
    return parts.join(F.broadcast(fixed.select("file_name").distinct()), "file_name", "left_anti").unionByName(fixed)


def file_schemas(parts: DataFrame) -> DataFrame:
    """Per-file schema rows ``(file_name, ordinal, column, type)`` from the rows of all its parts.

    A column that any part has is a column of the file, of the type that holds the values of every
    part (``functions.schema.merged_type``); the order does not depend on the names of the parts. A
    file with a part that cannot be read, or with parts whose types do not go together (or whose
    column names differ in case only), gets one marker row instead.
    """
    broken = (parts.where(F.col("column") == UNREADABLE).groupBy("file_name").agg(F.min("type").alias("type"))
              .select("file_name", F.lit(0).alias("ordinal"), F.lit(UNREADABLE).alias("column"), "type"))
    merged = (parts.where(F.col("column") != UNREADABLE).groupBy("file_name", F.lower("column").alias("key"))
              .agg(F.array_sort(F.collect_set("column")).alias("names"), F.array_sort(F.collect_set("type")).alias("types"),
                   F.max("ordinal").alias("last"), F.min("ordinal").alias("first")))
    name = F.element_at("names", 1)
    merged = merged.select("file_name", "last", "first", name.alias("name"), merged_type(F.col("types")).alias("type"),
                           F.when(F.size("names") > 1, F.concat(F.lit("columns differ in case: "), F.array_join("names", ", ")))
                           .when(merged_type(F.col("types")).isNull(),
                                 F.concat(name, F.lit(": "), F.array_join("types", ", "))).alias("problem"))
    whole = (merged.groupBy("file_name")
             .agg(F.array_sort(F.collect_list(F.struct("last", "first", "name", "type"))).alias("cols"),
                  F.array_sort(F.collect_list("problem")).alias("problems"))
             .join(broken.select("file_name"), "file_name", "left_anti"))
    columns = (whole.where(F.size("problems") == 0).select("file_name", F.posexplode("cols").alias("i", "c"))
               .select("file_name", (F.col("i") + 1).alias("ordinal"), F.col("c.name").alias("column"),
                       F.col("c.type").alias("type")))
    clashing = (whole.where(F.size("problems") > 0)
                .select("file_name", F.lit(0).alias("ordinal"), F.lit(CONFLICT).alias("column"),
                        F.array_join("problems", "; ").alias("type")))
    return columns.unionByName(clashing).unionByName(broken)


def readable(schemas: DataFrame) -> DataFrame:
    """The rows of :func:`file_schemas` without the markers."""
    return schemas.where(~F.col("column").isin(UNREADABLE, CONFLICT))


def rejected(schemas: DataFrame) -> DataFrame:
    """(file_name, error) of the files that cannot be scanned."""
    kind = F.when(F.col("column") == UNREADABLE, "unreadable: ").otherwise("incompatible parts: ")
    return (schemas.where(F.col("column").isin(UNREADABLE, CONFLICT))
            .select("file_name", F.concat(kind, "type").alias("error")))


@dataclass(frozen=True)
class Route:
    """Parts with the same columns: what one scan reads."""

    columns: tuple[tuple[str, str], ...]
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Group:
    """Files of one schema: its columns and the routes of their parts."""

    columns: tuple[tuple[str, str], ...]
    routes: tuple[Route, ...]
    files: tuple[str, ...] = ()

    def without(self, files: set[str], spark: SparkSession, root: str) -> Group | None:
        """The group without some of its files."""
        base = root_path(spark, root)
        left = []
        for r in self.routes:
            paths = tuple(p for p in r.paths if _entry(p, base) not in files)
            left += [Route(r.columns, paths)] if paths else []
        return Group(self.columns, tuple(left), tuple(f for f in self.files if f not in files)) if left else None


def _entry(path: str, base: str) -> str:
    """Name of the top-level entry below ``base`` that holds ``path`` (as listed, unencoded)."""
    bare = path.split("://", 1)[1] if "://" in path else path.removeprefix("file:")
    return bare[bare.index(base + "/") + len(base) + 1:].split("/", 1)[0]


def plan_scans(parts: DataFrame, schemas: DataFrame, files: DataFrame) -> list[Group]:
    """The scans to open, by schema group.

    ``parts`` and ``schemas`` are the rows of :func:`part_schemas` and :func:`file_schemas`, ``files``
    has ``file_name``, ``path``, ``leaf``. The driver gets one path per file, and the paths of the
    parts only of files whose parts differ.
    """
    def columns(rows: DataFrame, *keys: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("ordinal", "column", "type")))
        return rows.groupBy(*keys).agg(F.transform(ordered, lambda x: F.struct(x["column"].alias("c"), x["type"].alias("t")))
                                       .alias("cols"))

    whole = columns(readable(schemas), "file_name").withColumnRenamed("cols", "entry")
    part = columns(parts, "file_name", "leaf")
    kinds = part.groupBy("file_name").agg(F.min(F.xxhash64(F.to_json("cols"))).alias("lo"),
                                          F.max(F.xxhash64(F.to_json("cols"))).alias("hi"))
    paths = files.groupBy("file_name").agg(F.min("path").alias("path"))
    known = part.join(kinds, "file_name").join(whole, "file_name").join(paths, "file_name")
    path = F.when((F.col("lo") == F.col("hi")) | F.col("leaf").isNull(), F.col("path")).otherwise(F.col("leaf"))
    rows = known.select("file_name", "entry", "cols", path.alias("path")).distinct().collect()
    groups: dict[tuple, dict[tuple, list[str]]] = {}
    names: dict[tuple, set[str]] = {}
    for r in sorted(rows, key=lambda r: r["path"]):
        entry, cols = (tuple((x["c"], x["t"]) for x in r[k]) for k in ("entry", "cols"))
        groups.setdefault(entry, {}).setdefault(cols, []).append(r["path"])
        names.setdefault(entry, set()).add(r["file_name"])
    return [Group(e, tuple(Route(c, tuple(p)) for c, p in routes.items()), tuple(sorted(names[e])))
            for e, routes in groups.items()]


def entry_name(spark: SparkSession, root: str) -> F.Column:
    """Name of the top-level entry under ``root`` holding the scanned row."""
    # the metadata path is URL-encoded; a plus sign in it stands for itself
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.substring_index(below_root(path, root_path(spark, root)), "/", 1)


def _nanos_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that reads TIMESTAMP(NANOS) as longs; the caller's stays as it is."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return other


def scan_group(spark: SparkSession, root: str, paths: list[str], nanos: list[str] | None = None,
               **options: str) -> DataFrame:
    """One scan over files (or parts) of the same columns, with ``Source_File`` lineage.

    Parquet TIMESTAMP(NANOS) columns (pandas' default for datetime64[ns]) can
    only be read by Spark as longs; a session of its own reads them so
    (``spark.sql.legacy.parquet.nanosAsLong``), and the columns are turned
    back into wall-clock timestamps.
    """
    reader = (_nanos_session(spark) if nanos else spark).read
    df = reader.options(**_READ, **options).parquet(*paths)
    # lineage first: later columns hide the metadata of a scan that is united with others
    df = df.select(*[(nanos_to_timestamp_ntz(col(c)) if c in (nanos or []) else col(c)).alias(c)
                     for c in df.columns if c != SOURCE_FILE], entry_name(spark, root).alias(SOURCE_FILE))
    if nanos:  # an empty frame of the caller's session in front makes the union one of that session
        df = spark.createDataFrame([], df.schema).unionAll(df)
    return df


def scan(spark: SparkSession, root: str, group: Group, **options: str) -> DataFrame:
    """The rows of a schema group: a scan per kind of part, each with the group's columns."""
    parts = []
    for route in group.routes:
        own = dict(route.columns)
        df = scan_group(spark, root, list(route.paths), [c for c, t in route.columns if t == NANOS], **options)
        columns = []
        for c, t in group.columns:
            t = "timestamp_ntz" if t == NANOS else t
            if c == SOURCE_FILE:
                continue
            if c not in own:
                columns.append(F.lit(None).cast(t).alias(c))
            else:
                columns.append(col(c) if own[c] in (t, NANOS) and t != "timestamp" else col(c).cast(t).alias(c))
        parts.append(df.select(*columns, SOURCE_FILE))
    return reduce(lambda a, b: a.unionAll(b), parts)


def damaged_files(spark: SparkSession, root: str, group: Group) -> list[str]:
    """Names of the files of a schema group whose data pages cannot all be read.

    One scan decodes every column and skips the rest of a damaged file; its
    row count then falls short of the one in the footers.
    """
    told = scan(spark, root, group).groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("told"))
    found = scan(spark, root, group, ignoreCorruptFiles="true")
    values = [F.xxhash64(col(c).cast("string")) for c in found.columns if c != SOURCE_FILE]
    seen = (found.select(SOURCE_FILE, F.xxhash64(*values).alias("hash"))
            .groupBy(SOURCE_FILE).agg(F.count("hash").alias("seen"), F.max("hash").alias("top")))
    # the test of ``top`` keeps every column in the scan
    short = told.join(seen, SOURCE_FILE, "left").where(F.col("top").isNull() | (F.col("seen") < F.col("told")))
    return [r[0] for r in short.select(SOURCE_FILE).collect()]
