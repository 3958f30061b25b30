"""Written data constraints: missing rate, JSON validity, uniqueness per group.

Each is one aggregation (per-column rates) or the repeated-key plan of
:mod:`keys` (uniqueness), returning one row per checked column or group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import is_missing, json_valid
from ..functions.schema import col


def _rates(df: DataFrame, per_col: dict, measure, rate_name: str, limit_name: str, passed) -> DataFrame:
    cols = [c for c in per_col if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], f"column string, {rate_name} double, {limit_name} double, passed boolean")
    agg = df.agg(*[F.avg(measure(c).cast("int")).alias(f"_r{i}") for i, c in enumerate(cols)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_r{i}").alias(rate_name),
                 F.lit(float(per_col[c])).alias(limit_name),
                 passed(F.col(f"_r{i}"), F.lit(float(per_col[c]))).alias("passed"))
        for i, c in enumerate(cols)])))


def missing_rates(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    """(column, missing_rate, max_missing_rate, passed) — rate over all rows; NaN is missing, as in the profile."""
    return _rates(df, limits, lambda c: is_missing(col(c), df.schema[c].dataType), "missing_rate", "max_missing_rate",
                  lambda r, lim: r <= lim)


def json_rates(df: DataFrame, floors: dict[str, float]) -> DataFrame:
    """(column, valid_rate, min_valid_rate, passed) — rate over non-null values."""
    return _rates(df, floors, lambda c: json_valid(col(c)), "valid_rate", "min_valid_rate", lambda r, lim: r >= lim)


def unique_per_group(df: DataFrame, group: list[str], key: str) -> DataFrame:
    """(group..., ids, distinct_ids, duplicated_ids, passed) over non-null keys.

    Counted per (group, key), then per group, both combined map-side. A null
    group is a group of its own.
    """
    src = df.where(col(key).isNotNull())
    gcols = [col(g) for g in group]
    per_key = src.groupBy(*gcols, col(key)).agg(F.count(F.lit(1)).alias("n"))
    out = per_key.groupBy(*gcols).agg(
        F.sum("n").cast("long").alias("ids"),
        F.count(F.lit(1)).cast("long").alias("distinct_ids"),
        F.count_if(F.col("n") > 1).cast("long").alias("duplicated_ids"))
    return out.withColumn("passed", F.col("duplicated_ids") == 0)
