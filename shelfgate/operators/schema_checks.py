"""Column-level checks over per-file schema rows.

Input is a DataFrame ``(file_name, ordinal, column, type)`` with one row per
column of each file (see :func:`sources.listing.file_schemas`). Checks are
row filters or group by file — a group is one file's columns, bounded by
the schema width — and compare against the canonical schema held as literal
arrays and maps, so there is no join and no cross product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.schema import CANONICAL, compatible_col, required_names, schema_rows


def schema_missing(schemas: DataFrame, required: list[str] | None = None) -> DataFrame:
    """(file_name, missing_column) for each required column a file lacks.

    Each file's present required columns fold into bit masks (``bit_or``, a
    fixed-width hash aggregate) of 62 names each; the missing names are read
    off the masks.
    """
    req = required or required_names()
    masks, absent = [], []
    for m, lo in enumerate(range(0, len(req), 62)):
        names = req[lo:lo + 62]
        bits = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(c), F.lit(1 << i).cast("long"))])
        bit = F.element_at(bits, F.col("column"))
        masks.append(F.bit_or(F.coalesce(bit, F.lit(0).cast("long"))).alias(f"_m{m}"))
        absent += [F.when(F.col(f"_m{m}").bitwiseAND(F.lit(1 << i)) == 0, F.lit(c)) for i, c in enumerate(names)]
    return (schemas.groupBy("file_name").agg(*masks)
            .select("file_name", F.explode(F.array(*absent)).alias("missing_column"))
            .where(F.col("missing_column").isNotNull()))


def schema_extra(schemas: DataFrame, schema: StructType = CANONICAL) -> DataFrame:
    """(file_name, extra_column) for each column not in the canonical schema (a filter, no shuffle)."""
    return (schemas.where(~F.col("column").isin(schema.fieldNames()))
            .select("file_name", F.col("column").alias("extra_column")))


def type_mismatch(schemas: DataFrame, schema: StructType = CANONICAL) -> DataFrame:
    """(file_name, column, expected_type, actual_type) for incompatible canonical columns."""
    expected = F.create_map(*[x for f in schema.fields
                              for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    e = F.element_at(expected, F.col("column"))
    return (schemas.select("file_name", "column", e.alias("expected_type"), F.col("type").alias("actual_type"))
            .where(F.col("expected_type").isNotNull()
                   & ~compatible_col(F.col("actual_type"), F.col("expected_type"))))


def schema_signature(schemas: DataFrame) -> DataFrame:
    """(file_name, n_columns, signature): ordered ``name:type`` list per file."""
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "column", "type")))
    sig = F.array_join(F.transform(ordered, lambda x: F.concat(x["column"], F.lit(":"), x["type"])), ",")
    return schemas.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_columns"), sig.alias("signature"))


def schema_groups(schemas: DataFrame) -> DataFrame:
    """Files with identical ordered (name, type) lists form one group.

    One row per group: a stable id (hash of the signature), file count,
    column count, first file name and the signature. Files are counted,
    never collected into one row.
    """
    sig = schema_signature(schemas)
    return (sig.groupBy("signature", "n_columns")
            .agg(F.count(F.lit(1)).alias("n_files"), F.min("file_name").alias("first_file"))
            .select(F.sha2(F.col("signature"), 256).alias("schema_group"),
                    "n_files", "n_columns", "first_file", "signature"))


def file_schema_group(schemas: DataFrame) -> DataFrame:
    """(file_name, schema_group) for routing each file to its group's scan."""
    return schema_signature(schemas).select(
        "file_name", F.sha2(F.col("signature"), 256).alias("schema_group"))


def schema_listing(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``printSchema`` as rows: (ordinal, column, type, nullable)."""
    return spark.createDataFrame(schema_rows(df.schema),
                                 "ordinal int, column string, type string, nullable boolean")


def new_column_log(schemas: DataFrame, detection_time: str, schema: StructType = CANONICAL) -> DataFrame:
    """Column-change log rows ``(file_name, new_column, detection_time)``."""
    return schema_extra(schemas, schema).select(
        "file_name", F.col("extra_column").alias("new_column"),
        F.to_timestamp(F.lit(detection_time)).alias("detection_time"))
