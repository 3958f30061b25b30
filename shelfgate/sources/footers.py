"""Column facts of a parquet table from its footers alone.

Every row group's footer holds row counts, null counts and the smallest and
largest value of its columns. :func:`column_facts` reads them on the
executors (a task reads ``FOOTERS_PER_TASK`` files; only the last bytes of a
file, no data page) and adds them up; the driver gets one row per column.
The audit and profile operators take these facts and scan only the columns
whose facts are missing or not exact:

* null counts where every row group of every file has one (a file without
  the column counts with all its rows); NaN is not counted by footers, so
  missing values of floating columns are still scanned;
* smallest and largest values of integers, decimals, booleans, dates and
  timestamps; of texts if they are shorter than writers cut them
  (``EXACT_TEXT`` bytes); not of floating columns, whose footers leave NaN out.

A file whose footer cannot be read that way makes every fact unknown, so
that all is scanned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from .listing import FOOTERS_PER_TASK

# writers that cut texts keep at least this many bytes
EXACT_TEXT = 64
_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_ROW = ("leaf string, column string, rows long, groups long, nulls long, null_groups long, bounds long, "
        "low long, high long, low_text string, high_text string")


@dataclass(frozen=True)
class Facts:
    """What the footers tell of one column: None where they do not tell it exactly."""

    rows: int
    nulls: int | None
    low: Column | None = None
    high: Column | None = None


def _statistics(batches):
    """mapInPandas body: per file and column, the sums and bounds over its row groups."""
    import datetime as dt
    import decimal

    import pandas as pd
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    epoch = dt.datetime(1970, 1, 1)

    def number(v):
        """Integers, booleans, days, microseconds, unscaled decimals as an int; None for anything else."""
        if isinstance(v, bool | int):
            return int(v)
        if isinstance(v, decimal.Decimal):
            return int(v.scaleb(-v.as_tuple().exponent))
        if isinstance(v, dt.datetime):
            return (v.replace(tzinfo=None) - epoch) // dt.timedelta(microseconds=1)
        return (v - epoch.date()).days if isinstance(v, dt.date) else None

    for pdf in batches:
        out = []
        for path in pdf["leaf"]:
            uri = path if "://" in path else "file://" + path.removeprefix("file:")
            try:
                fs, inner = pafs.FileSystem.from_uri(uri)
                footer = pq.read_metadata(inner, filesystem=fs)
            except Exception:  # noqa: BLE001 - this file tells nothing
                out.append((path, None, None, 0, None, 0, 0, None, None, None, None))
                continue
            columns = {}
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                for i in range(group.num_columns):
                    chunk = group.column(i)
                    c = columns.setdefault(chunk.path_in_schema, [0, 0, 0, 0, [], []])
                    c[0] += group.num_rows
                    c[1] += 1
                    try:
                        st = chunk.statistics
                        if st is None:
                            continue
                        if st.has_null_count:
                            c[2] += st.null_count
                            c[3] += 1
                        if st.has_min_max:
                            c[4].append((st.min, st.max))
                        elif st.has_null_count and st.null_count == group.num_rows:
                            c[5].append(g)  # nothing but nulls: no bounds to tell
                    except Exception:  # noqa: BLE001 - statistics of a kind that cannot be read
                        continue
            out.append((path, "", footer.num_rows, footer.num_row_groups, 0, 0, 0, None, None, None, None))
            for name, (rows, groups, nulls, null_groups, bounds, empty) in columns.items():
                texts = [b for b in bounds if isinstance(b[0], str | bytes)]
                pairs = [(number(a), number(b)) for a, b in bounds]
                pairs = [p for p in pairs if p[0] is not None and max(abs(p[0]), abs(p[1])) < 2 ** 63]
                decoded = []
                for a, b in texts:
                    try:
                        a, b = (x if isinstance(x, str) else x.decode() for x in (a, b))
                    except UnicodeDecodeError:
                        continue
                    if max(len(a.encode()), len(b.encode())) < EXACT_TEXT:
                        decoded.append((a, b))
                told = len(pairs) + len(decoded) + len(empty)
                keys = [(a.encode(), b.encode()) for a, b in decoded]
                out.append((path, name, rows, groups, nulls, null_groups, told,
                            min((p[0] for p in pairs), default=None), max((p[1] for p in pairs), default=None),
                            min(k[0] for k in keys).decode() if keys else None,
                            max(k[1] for k in keys).decode() if keys else None))
        frame = pd.DataFrame(out, columns=[f.split()[0] for f in _ROW.split(", ")], dtype=object)
        yield frame


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """``leaf``: the data files of a table."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(path).select(F.col("path").alias("leaf")))


def _literal(number: int | None, text: str | None, t: DataType) -> Column | None:
    if isinstance(t, StringType):
        return None if text is None else F.lit(text)
    if number is None:
        return None
    if isinstance(t, _INTEGRAL):
        return F.lit(number).cast(t)
    if isinstance(t, BooleanType):
        return F.lit(bool(number))
    if isinstance(t, DecimalType):
        return F.lit(f"{number}e-{t.scale}").cast("decimal(38,18)").cast(t) if t.precision <= 18 else None
    if isinstance(t, DateType):
        return F.date_from_unix_date(F.lit(number).cast("int"))
    if isinstance(t, TimestampType):
        return F.timestamp_micros(F.lit(number))
    if isinstance(t, TimestampNTZType):
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), (F.lit(number).cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)"))
    return None


def column_facts(spark: SparkSession, path: str) -> dict[str, Facts]:
    """The facts of every top-level column of the table at ``path``; empty if some footer tells nothing.

    One row per column comes to the driver.
    """
    files = table_files(spark, path)
    parts = max(1, -(-files.count() // FOOTERS_PER_TASK))
    rows = files.repartition(parts).mapInPandas(_statistics, _ROW)
    # texts are compared by their bytes, as Spark and the footers do
    found = rows.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("groups").alias("groups"), F.sum("nulls").alias("nulls"),
        F.sum("null_groups").alias("null_groups"), F.sum("bounds").alias("bounds"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"))
    by = {r["column"]: r for r in found.collect()}
    if None in by or "" not in by:
        return {}
    total = by.pop("")["rows"]
    out = {}
    for f in spark.read.parquet(path).schema.fields:
        r = by.get(f.name)
        if r is None or "." in f.name:
            continue
        nulls = r["nulls"] + total - r["rows"] if r["null_groups"] == r["groups"] else None
        exact = r["bounds"] == r["groups"]
        out[f.name] = Facts(total, nulls, *(_literal(r[n], r[f"{n}_text"], f.dataType) if exact else None
                                            for n in ("low", "high")))
    return out
