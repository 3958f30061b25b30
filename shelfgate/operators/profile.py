"""Data profile: missing values, constants, kinds, correlation, association,
dataset summary.

Every statistic is an aggregation that Spark combines map-side:

* per-column counts and min/max come from one ``agg`` and are unpivoted;
* exact distinct counts come from a ``(column, value)`` unpivot followed by
  ``distinct`` and a count per column — one shuffle of distinct pairs,
  never a set collected into one row;
* categorical association (Cramér's V) explodes each row into one
  ``(pair, a, b)`` entry per column pair (bounded by the schema width) and
  aggregates the contingency counts map-side; values that occur once share
  one entry, so cells do not grow with the rows of unique columns;
* duplicate rows use the repeated-key plan of :mod:`keys` over all columns
  (a 64-bit row hash first, exact comparison only where hashes repeat).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from ..functions.predicates import is_missing
from ..functions.schema import col
from ..sources.footers import Facts
from .keys import marked_repeats, repeated_keys

# --- fixed values: distinct-count ceiling for a categorical text column ----
CATEGORICAL_MAX_DISTINCT = 50
# levels from which the values of a column that occur once are counted apart (see categorical_association)
SINGLES_FROM = 1000


def one_row(df: DataFrame, aggregates: list[Column]) -> DataFrame:
    """The aggregates as one row; without any, a row that needs no scan."""
    return df.agg(*aggregates) if aggregates else df.sparkSession.range(1).drop("id")


def missing(df: DataFrame, known: dict[str, Facts] | None = None) -> DataFrame:
    """(column, n_missing, pct_missing) for every column; NaN counts as missing.

    ``known``: facts of the table's footers (``sources.footers.column_facts``). Columns they tell
    are not scanned; if they tell all, nothing is.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    told = {c: f for c, f in (known or {}).items()
            if f.nulls is not None and not isinstance(types.get(c), (DoubleType, FloatType))}
    rows = [F.lit(f.rows).cast("long") for f in (known or {}).values()][:1]
    scanned = [F.count_if(is_missing(col(c), types[c])).alias(f"_m{i}")
               for i, c in enumerate(df.columns) if c not in told]
    agg = one_row(df, ([] if rows else [F.count(F.lit(1)).alias("_rows")]) + scanned)
    n_rows = rows[0] if rows else F.col("_rows")
    count = [F.lit(told[c].nulls) if c in told else F.col(f"_m{i}") for i, c in enumerate(df.columns)]
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), n.cast("long").alias("n_missing"),
                 F.try_divide(n * 100.0, n_rows).alias("pct_missing"))
        for c, n in zip(df.columns, count)])))


def constant_columns(df: DataFrame, known: dict[str, Facts] | None = None) -> DataFrame:
    """(column) for columns with exactly one distinct non-null value.

    Tested as ``min = max`` over non-null values: one pass, no distinct set.
    Values without an order (maps, variants) and nested ones are compared as text. Columns whose
    bounds the footers tell (``known``) are not scanned.
    """
    if not df.columns:
        return df.sparkSession.createDataFrame([], "column string")
    bounds, scanned = _bounds(df, df.columns, known, lambda c: _ordered(col(c), df.schema[c].dataType))
    agg = one_row(df, scanned)
    flags = F.array(*[F.struct(F.lit(c).alias("column"), (lo == hi).alias("is_constant"))
                      for c, (lo, hi) in bounds.items()])
    return agg.select(F.inline(flags)).where(F.col("is_constant")).select("column")


def _bounds(df: DataFrame, columns: list[str], known: dict[str, Facts] | None, value):
    """(smallest, largest) of each column, as literals where ``known`` tells them, and the aggregates for the others."""
    bounds, scanned = {}, []
    for i, c in enumerate(columns):
        facts = (known or {}).get(c)
        if facts and facts.nulls == facts.rows:
            bounds[c] = (F.lit(None).cast(df.schema[c].dataType),) * 2
        elif facts and facts.low is not None and facts.high is not None:
            bounds[c] = (facts.low, facts.high)
        else:
            scanned += [F.min(value(c)).alias(f"_lo{i}"), F.max(value(c)).alias(f"_hi{i}")]
            bounds[c] = (F.col(f"_lo{i}"), F.col(f"_hi{i}"))
    return bounds, scanned


def _ordered(c: Column, t: DataType) -> Column:
    plain = (NumericType, StringType, BinaryType, BooleanType, TimestampType, TimestampNTZType, DateType)
    return c if isinstance(t, plain) else c.cast("string")


def distinct_counts(df: DataFrame, columns: list[str] | None = None,
                    approx_rsd: float | None = None) -> DataFrame:
    """(column, n_distinct), nulls excluded, for the given columns.

    Exact by default (one shuffle of distinct ``(column, value)`` pairs).
    With ``approx_rsd`` it is one HyperLogLog++ pass with no value shuffle,
    for very wide text columns where an estimate is enough.
    """
    cols = columns or df.columns
    if approx_rsd is not None:
        agg = df.agg(*[F.approx_count_distinct(col(c), rsd=approx_rsd).alias(f"_d{i}")
                       for i, c in enumerate(cols)])
        return agg.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").cast("long").alias("n_distinct"))
            for i, c in enumerate(cols)])))
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in cols])))
    per_col = (pairs.where(F.col("value").isNotNull()).distinct()
               .groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct")))
    # columns with no non-null value still get a row
    zero = df.sparkSession.createDataFrame([(c, 0) for c in cols], "column string, n_distinct long")
    return (per_col.unionByName(zero).groupBy("column")
            .agg(F.max("n_distinct").cast("long").alias("n_distinct")))


def column_stats(df: DataFrame, max_categorical: int = CATEGORICAL_MAX_DISTINCT,
                 approx_rsd: float | None = None) -> DataFrame:
    """(column, kind, n_nonnull, n_distinct) — kind is Boolean, DateTime, Numeric,
    Categorical, Text or Unsupported.

    Unsupported = no non-null value; text columns with at most
    ``max_categorical`` distinct values are Categorical, the rest Text.
    ``n_distinct`` is exact for text and boolean columns at every size, and
    null for other kinds.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    counted = [c for c in df.columns if isinstance(types[c], (StringType, BooleanType))]
    nonnull = df.agg(*[F.count(col(c)).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    base = nonnull.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(_static_kind(types[c])).alias("_k"),
                 F.col(f"_c{i}").alias("n_nonnull"))
        for i, c in enumerate(df.columns)])))
    if counted:
        nd = distinct_counts(df, counted, approx_rsd)
        base = base.join(F.broadcast(nd), "column", "left")  # at most one row per column
    else:
        base = base.withColumn("n_distinct", F.lit(None).cast("long"))
    kind = (F.when(F.col("n_nonnull") == 0, "Unsupported")
            .when(F.col("_k") != "Text", F.col("_k"))
            .when(F.coalesce(F.col("n_distinct") <= max_categorical, F.lit(False)), "Categorical")
            .otherwise("Text"))
    return base.select("column", kind.alias("kind"), F.col("n_nonnull").cast("long").alias("n_nonnull"),
                       "n_distinct")


def kinds(df: DataFrame, max_categorical: int = CATEGORICAL_MAX_DISTINCT) -> DataFrame:
    """(column, kind) per column; see :func:`column_stats`."""
    return column_stats(df, max_categorical).select("column", "kind")


def _static_kind(t: DataType) -> str:
    if isinstance(t, BooleanType):
        return "Boolean"
    if isinstance(t, (TimestampType, TimestampNTZType, DateType)):
        return "DateTime"
    if isinstance(t, NumericType):
        return "Numeric"
    if isinstance(t, StringType):
        return "Text"
    return "Unsupported"


def kind_counts(kinds_df: DataFrame) -> DataFrame:
    return kinds_df.groupBy("kind").agg(F.count(F.lit(1)).alias("variables"))


def numeric_correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_a, column_b, corr) Pearson over the rows where neither value is missing (null or NaN)."""
    num = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    pairs = list(combinations(num, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")

    def value(c: str) -> Column:
        floating = isinstance(df.schema[c].dataType, (DoubleType, FloatType))
        return (F.when(~F.isnan(col(c)), col(c)) if floating else col(c)).cast("double")

    agg = df.agg(*[F.corr(value(a), value(b)).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                 F.col(f"_r{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)])))


def categorical_association(df: DataFrame, columns: list[str] | dict[str, int]) -> DataFrame:
    """(column_a, column_b, cramers_v, n) for every pair of the given columns.

    chi2 = n * (sum_ab n_ab^2 / (n_a n_b) - 1) over observed cells only;
    V = sqrt(chi2 / (n * (min(r, c) - 1))), null when a side has one level.
    Rows where either value is null are left out of that pair's table; a pair
    without a row left gives none.

    A value that occurs once in its column makes a cell of one row, whose
    share of the sum follows from the other margin alone. So in columns of
    many levels (``columns`` may give the counts, see
    :func:`association_columns`) such values are not told apart: their rows
    are counted together, map-side, and a column that is unique, or nearly,
    adds few cells to its pairs. A bit map of fixed size tells them; a value
    it takes for a repeated one is counted like those.

    Only one margin is joined to the cells, that of the column with more
    levels, where few cells share a value; the other follows from a combined
    sum.
    """
    levels = columns if isinstance(columns, dict) else {
        r["column"]: r["n_distinct"] for r in distinct_counts(df, list(columns)).collect()}
    names = list(columns)
    wide = len(names)
    if wide < 2:
        return df.sparkSession.createDataFrame(
            [], "column_a string, column_b string, cramers_v double, n long")
    values = df.select(*[col(c).cast("string").alias(f"v{i}") for i, c in enumerate(names)])
    many_levels = [i for i, c in enumerate(names) if levels[c] >= SINGLES_FROM]
    if many_levels:
        values = marked_repeats(values, {f"repeats{i}": [f"v{i}"] for i in many_levels})
    # null: there is no value; otherwise the value, itself null where it occurs once
    entry = [F.when(F.col(f"v{i}").isNotNull(), F.struct(
        (F.when(F.col(f"repeats{i}"), F.col(f"v{i}")) if i in many_levels else F.col(f"v{i}")).alias("x")))
        for i in range(wide)]
    # The values are made once per row; the rows of the pairs pick theirs by position.
    # A pair's number holds both positions.
    picks = [(i * wide + j, *((i, j) if levels[a] <= levels[b] else (j, i)))
             for (i, a), (j, b) in combinations(enumerate(names), 2)]
    picks = F.expr("array(" + ", ".join(f"struct({p} AS pair, {i} AS few, {j} AS many)" for p, i, j in picks) + ")")
    cells = (values.select(F.array(*entry).alias("v")).select("v", F.explode(picks).alias("p"))
             .select(F.col("p.pair").alias("pair"), F.get("v", F.col("p.few")).alias("few"),
                     F.get("v", F.col("p.many")).alias("many")))
    cells = (cells.where(F.col("few").isNotNull() & F.col("many").isNotNull())
             .groupBy("pair", F.col("few.x").alias("few"), F.col("many.x").alias("many")).agg(F.count(F.lit(1)).alias("n_ab")))
    margin = (cells.where("many IS NOT NULL").groupBy(F.col("pair").alias("mpair"), F.col("many").alias("mvalue"))
              .agg(F.sum("n_ab").alias("n_b")))
    # sum of n_ab^2 / n_b over the cells that are counted together; doubles: at 10^12 rows the
    # products of counts overflow a long
    n_ab = F.col("n_ab").cast("double")
    share = (F.when(F.col("many").isNull(), n_ab).when(F.col("few").isNull(), F.try_divide(n_ab, F.col("n_b")))
             .otherwise(F.try_divide(n_ab * n_ab, F.col("n_b"))))
    rows = (cells.join(margin, (F.col("pair") == F.col("mpair")) & (F.col("many") == F.col("mvalue")), "left")
            .groupBy("pair", "few").agg(F.sum("n_ab").alias("n_a"), F.sum(share).alias("q"),
                                        F.sum(F.when(F.col("many").isNull(), F.col("n_ab")).otherwise(0)).alias("alone")))
    once = F.col("few").isNull()
    per_pair = rows.groupBy("pair").agg(
        F.sum("n_a").alias("n"), F.sum(F.when(once, F.col("q")).otherwise(F.try_divide("q", "n_a"))).alias("s"),
        F.sum(F.when(once, F.col("n_a")).otherwise(1)).alias("r"), F.sum("alone").alias("alone"))
    width = margin.groupBy("mpair").agg(F.count(F.lit(1)).alias("c"))
    per_pair = per_pair.join(width, F.col("pair") == F.col("mpair"), "left")
    k = F.least(F.col("r"), F.coalesce("c", F.lit(0)) + F.col("alone")) - 1
    v = F.when(k > 0, F.sqrt(F.try_divide(F.greatest(F.col("n") * (F.col("s") - 1), F.lit(0.0)), F.col("n") * k)))
    named = F.array(*[F.lit(c) for c in names])
    return per_pair.select(
        F.get(named, F.expr(f"pair DIV {wide}").cast("int")).alias("column_a"),
        F.get(named, F.col("pair") % wide).alias("column_b"),
        v.alias("cramers_v"),
        F.col("n").cast("long").alias("n"))


def association_columns(df: DataFrame, stats: DataFrame | None = None) -> dict[str, int]:
    """Text and boolean columns with more than one level, and their level counts.

    However many levels: V is undefined only for a single one. ``stats`` (see
    :func:`column_stats`) saves counting them; either way one row per column
    comes to the driver.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    counted = [c for c in df.columns if isinstance(types[c], (StringType, BooleanType))]
    if not counted:
        return {}
    found = stats.where(F.col("n_distinct").isNotNull()) if stats is not None else distinct_counts(df, counted)
    levels = {r["column"]: r["n_distinct"] for r in found.select("column", "n_distinct").collect()}
    return {c: levels[c] for c in counted if levels.get(c, 0) > 1}


def duplicate_row_count(df: DataFrame) -> int:
    """Rows minus distinct rows, exact: the repeated-key plan over all columns.

    Rows are counted by a 64-bit hash first (8 bytes per row cross the
    shuffle instead of whole rows) and only rows whose hash repeats are
    compared on all columns.
    """
    r = repeated_keys(df, df.columns, nulls_equal=True).agg(F.sum(F.col("_n") - 1).alias("d")).first()
    return int(r["d"] or 0)


def dataset_summary(df: DataFrame) -> DataFrame:
    """(rows, variables, missing_cells, missing_pct, duplicate_rows, duplicate_pct)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    miss = sum([F.count_if(is_missing(col(c), types[c])).cast("long") for c in df.columns], F.lit(0).cast("long"))
    nvar = len(df.columns)
    dups = duplicate_row_count(df)
    m = df.agg(F.count(F.lit(1)).alias("rows"), miss.alias("missing_cells"))
    return m.select(
        "rows", F.lit(nvar).cast("long").alias("variables"), "missing_cells",
        F.try_divide(F.col("missing_cells") * 100.0, F.col("rows") * nvar).alias("missing_pct"),
        F.lit(dups).cast("long").alias("duplicate_rows"),
        F.try_divide(F.lit(dups) * 100.0, F.col("rows")).alias("duplicate_pct"))


def price_bounds(df: DataFrame, columns: list[str], tolerance: float = 0.2,
                 known: dict[str, Facts] | None = None) -> DataFrame:
    """(column, observed_min, observed_max, min_bound, max_bound): bounds widened by ``tolerance``.

    Columns whose bounds the footers tell (``known``) are not scanned.
    """
    bounds, scanned = _bounds(df, columns, known, lambda c: col(c).cast("double"))
    return one_row(df, scanned).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), lo.cast("double").alias("observed_min"),
                 hi.cast("double").alias("observed_max"),
                 (lo.cast("double") * (1 - tolerance)).alias("min_bound"),
                 (hi.cast("double") * (1 + tolerance)).alias("max_bound"))
        for c, (lo, hi) in bounds.items()])))
