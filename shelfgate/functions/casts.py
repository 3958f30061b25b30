"""Column-level casts to canonical types.

All casts are null-on-failure (``try_*``): Spark 4 runs with ANSI mode on,
where a plain ``cast('$12.00' as float)`` raises instead of giving null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)


def _number(c: Column) -> Column:
    """Text as a double; the type suffixes and hexadecimal floats that Java reads are no numbers."""
    t = F.trim(c)
    return F.when(~t.rlike(r"[0-9.][dDfF]$|[xX]"), t.try_cast(DoubleType()))


def to_type(c: Column, source: DataType, target: DataType) -> Column:
    """Cast ``c`` (of type ``source``) to ``target``; bad values become null."""
    if source == target:
        return c
    if isinstance(target, TimestampType):
        if isinstance(source, StringType):
            return F.try_to_timestamp(c)
        if isinstance(source, (TimestampNTZType, DateType)):
            return c.cast(target)
        return c.try_cast(target)
    if isinstance(target, (FloatType, DoubleType)):
        if isinstance(source, StringType):
            # parse as double first so that the float rounding happens once
            return _number(c).cast(target)
        if isinstance(source, (NumericType, BooleanType)):
            return c.cast(target)
        return c.try_cast(target)
    if isinstance(target, (LongType, IntegerType)):
        if isinstance(source, StringType):
            return F.trim(c).try_cast(target)
        return c.try_cast(target)
    if isinstance(target, BooleanType):
        if isinstance(source, StringType):
            return F.trim(c).try_cast(target)
        return c.try_cast(target)
    if isinstance(target, StringType):
        return c.cast(target)
    return c.try_cast(target)


def as_double(c: Column, source: DataType) -> Column:
    """Numeric view of a raw column, used by range rules before the float cast."""
    if isinstance(source, DoubleType):
        return c
    if isinstance(source, StringType):
        return _number(c)
    return c.cast(DoubleType())


def typed_null(target: DataType) -> Column:
    return F.lit(None).cast(target)


def nanos_to_timestamp_ntz(c: Column) -> Column:
    """Nanoseconds since the epoch (a parquet TIMESTAMP(NANOS) read as a long) to a
    wall-clock ``timestamp_ntz``, truncated to microseconds.

    Built as epoch + day-time interval, so no session time zone is involved.
    """
    # exact decimal arithmetic: a double cannot hold 19-digit nanosecond counts
    micros = F.floor(c.cast("decimal(20,0)") / F.lit(1000))
    secs = (micros.cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(c.isNotNull(), epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs))
