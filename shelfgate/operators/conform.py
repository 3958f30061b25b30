"""Conformance: canonical projection, typed casts, fill, lineage, union.

Every function returns a single ``select`` over its input, so Catalyst sees
one Project (no chain of ``withColumn``) and column pruning reaches the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..functions.casts import to_type, typed_null
from ..functions.schema import CANONICAL, SOURCE_FILE


def canonical_projection(df: DataFrame, schema: StructType = CANONICAL) -> DataFrame:
    """Keep canonical columns that exist, in canonical order; drop extras."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{n}`") for n in schema.fieldNames() if n in present])


def conform_types(df: DataFrame, schema: StructType = CANONICAL, *,
                  fill_missing: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Cast present canonical columns to their canonical types (bad value -> null).

    ``fill_missing`` adds absent canonical columns as typed nulls, so every
    output has the full canonical schema; ``keep`` passes extra columns
    (lineage, flags) through unchanged after the canonical ones.
    """
    src = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in src:
            cols.append(to_type(F.col(f"`{f.name}`"), src[f.name], f.dataType).alias(f.name))
        elif fill_missing:
            cols.append(typed_null(f.dataType).alias(f.name))
    cols += [F.col(f"`{k}`") for k in (keep or []) if k in src]
    return df.select(*cols)


def conform_integer(df: DataFrame, columns: list[str]) -> DataFrame:
    """Integer coercion of the named columns (unparsable -> null), others unchanged."""
    src = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        to_type(F.col(f"`{c}`"), src[c], LongType()).alias(c) if c in columns else F.col(f"`{c}`")
        for c in df.columns
    ])


def with_source_file(df: DataFrame, name: str = SOURCE_FILE) -> DataFrame:
    """Lineage column from the scan's file metadata (file name only)."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def union_conformed(parts: list[DataFrame], schema: StructType = CANONICAL,
                    keep: list[str] | None = None) -> DataFrame:
    """Conform each part (with fill) and union them by name."""
    conformed = [conform_types(p, schema, fill_missing=True, keep=keep) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), conformed)
