"""Sinks: the unified table, the column-change log, the audit report.

All writes are Spark writes (one task per partition, committed by Spark's
output committer). The unified table is append-only by default, like the
reference; ``overwrite_partitions`` with ``partition_by`` makes a rerun of
the same week replace its partitions instead of duplicating rows, and
``sources.publish`` makes any rerun leave the table as it is.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..functions.schema import CANONICAL
from ..session import path_exists
from .publish import manifest_path, read_published

COLUMN_LOG_SCHEMA = StructType([
    StructField("file_name", StringType(), False),
    StructField("new_column", StringType(), False),
    StructField("detection_time", TimestampType(), False),
])


def write_unified(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                  overwrite_partitions: bool = False) -> None:
    """Append to the unified parquet table (created on first write)."""
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    if overwrite_partitions:
        if not partition_by:
            raise ValueError("overwrite_partitions needs partition_by")
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.parquet(path)


def read_unified(spark: SparkSession, path: str, schema: StructType = CANONICAL) -> DataFrame | None:
    """The unified table, or None when it does not exist. Whatever else keeps it from being read raises.

    Of a table that was published batch by batch (``sources.publish``), the committed rows.
    """
    if not path_exists(spark, path):
        return None
    if path_exists(spark, manifest_path(path)):
        return read_published(spark, path, schema)
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without any data file
            return None
        raise


def append_column_log(rows: DataFrame, path: str) -> None:
    """Append column-change rows; never rewrites the existing log."""
    rows.select(*COLUMN_LOG_SCHEMA.fieldNames()).write.mode("append").parquet(path)


def read_column_log(spark: SparkSession, path: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    return spark.read.schema(COLUMN_LOG_SCHEMA).parquet(path)
