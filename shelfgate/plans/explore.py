"""Exploration of a landing folder: schema groups, normalized union with
lineage, and the data profile (the reference's exploration notebook).

Every file of the folder is taken (not only the newest). Files are grouped
by their ordered ``(name, type)`` list, which all their parts make together;
every group is normalized to the exploration schema (64-bit floats, missing
canonical columns filled) with ``Source_File`` lineage, and the groups are
unioned by name. Files that cannot be read, and files whose parts do not go
together, are reported and left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.schema import CANONICAL, SOURCE_FILE, eda_schema
from ..operators import profile as P
from ..operators.catalog import usable
from ..operators.conform import conform_types
from ..operators.schema_checks import schema_groups
from ..sources.catalog import read_catalog
from ..sources.listing import scan
from .ingest import read_landing


@dataclass
class ExploreResult:
    groups: DataFrame            # one row per schema group
    unified: DataFrame | None    # normalized rows of every readable file, with Source_File
    unreadable: DataFrame        # (file_name, error)


def explore(spark: SparkSession, input_dir: str, sources: list[str] | None = None,
            schema: StructType = CANONICAL, files: list[str] | None = None) -> ExploreResult:
    """Group, normalize and union the folder's listing files (or only ``files``, by name)."""
    catalog = usable(read_catalog(spark, input_dir, sources))
    if files is not None:
        catalog = catalog.where(F.col("file_name").isin(list(files)))
    landing = read_landing(spark, input_dir, catalog)
    unreadable = spark.createDataFrame(landing.rejected, "file_name string, error string")
    parts = [conform_types(scan(spark, input_dir, group), eda_schema(schema), fill_missing=True, keep=[SOURCE_FILE])
             for group in landing.groups]
    unified = reduce(lambda a, b: a.unionByName(b), parts) if parts else None
    return ExploreResult(schema_groups(landing.schemas), unified, unreadable)


def profile_report(df: DataFrame, max_categorical: int = P.CATEGORICAL_MAX_DISTINCT,
                   approx_rsd: float | None = None) -> dict[str, DataFrame]:
    """All profile statistics of ``df`` as DataFrames (the HTML report's numbers).

    ``max_categorical``: most levels of a text column of the kind Categorical;
    ``approx_rsd``: estimate distinct counts with HLL++.
    """
    stats = P.column_stats(df, max_categorical, approx_rsd)
    kinds = stats.select("column", "kind")
    return {
        "dataset": P.dataset_summary(df),
        "missing": P.missing(df),
        "constant": P.constant_columns(df),
        "kinds": kinds,
        "kind_counts": P.kind_counts(kinds),
        "correlation": P.numeric_correlation(df),
        "association": P.categorical_association(df, P.association_columns(df, stats)),
    }
