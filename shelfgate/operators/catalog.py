"""Catalog operators: latest file per source as of a date, newest-first order,
files per source.

``latest_as_of`` is a top-1 per group written as a ``max`` over a struct, so
it is a partial (map-side) aggregation: a source with a third of all files
costs no more than any other.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.col("status") == "ok")


def latest_as_of(catalog: DataFrame, reference_date: _dt.date | str) -> DataFrame:
    """Newest file per retailer with ``file_date <= reference_date``.

    Ties on the date break by time, then by name (the reference leaves them
    to directory order).
    """
    ref = F.to_date(F.lit(str(reference_date)[:10]))
    newest = F.max(F.struct("file_date", "file_time", "file_name", "path"))
    return (usable(catalog).where(F.col("file_date") <= ref)
            .groupBy("retailer").agg(newest.alias("m"))
            .select("retailer", "m.file_name", "m.path", "m.file_date", "m.file_time"))


def default_reference_date(today: _dt.date) -> _dt.date:
    """The reference's default: one day before ``today`` (passed in, never read)."""
    return today - _dt.timedelta(days=1)


def newest_first(catalog: DataFrame) -> DataFrame:
    """Files per retailer, newest first (global sort: range-partitioned, scales)."""
    return (usable(catalog)
            .select("retailer", "file_name", "path", "file_date", "file_time")
            .orderBy(F.col("retailer"), F.col("file_date").desc(), F.col("file_time").desc(),
                     F.col("file_name").desc()))


def files_per_retailer(catalog: DataFrame) -> DataFrame:
    return usable(catalog).groupBy("retailer").agg(F.count(F.lit(1)).alias("files"))


def catalog_status_counts(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("status").agg(F.count(F.lit(1)).alias("files"))
