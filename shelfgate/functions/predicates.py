"""Row predicates shared by rules, audit and profile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def is_missing(c: Column, dtype: DataType) -> Column:
    """Null, or NaN for floating columns (pandas ``isnull`` semantics)."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def outside(c: Column, lo: float | None, hi: float | None) -> Column:
    """Strictly outside ``[lo, hi]``; null and NaN are never outside.

    Spark orders NaN above every number, so ``NaN > hi`` would be true;
    the guard keeps NaN rows passing like pandas comparisons do.
    """
    conds = []
    if lo is not None:
        conds.append(c < F.lit(float(lo)))
    if hi is not None:
        conds.append(c > F.lit(float(hi)))
    if not conds:
        return F.lit(False)
    out = conds[0]
    for x in conds[1:]:
        out = out | x
    return F.coalesce(out & ~F.isnan(c), F.lit(False))


def json_valid(c: Column) -> Column:
    """True when the text parses as JSON, null when the text is null."""
    return F.when(c.isNotNull(), F.try_parse_json(c).isNotNull())
