"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Inputs are views derived from the shared tables (``sources.fixtures``), so
every query reads whole tables and its work grows with them. Column names
match the SQL oracle in :mod:`shelfgate.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StringType, StructField, StructType

from ..functions.schema import SOURCE_FILE, eda_schema, required_names
from ..operators import audit as A
from ..operators import catalog as C
from ..operators import constraints as K
from ..operators import json_structure as J
from ..operators import profile as P
from ..operators import schema_checks as S
from ..operators.conform import (
    canonical_projection,
    conform_integer,
    conform_types,
    union_conformed,
)
from ..operators.gate import gate
from ..operators.key_history import KeyHistory
from ..operators.rules import JSON_RATE_FLOORS, MISSING_RATE_LIMITS, RANGE_TOLERANCE, default_rules, parse_rules
from ..operators.weekly_state import WeeklyProfile
from ..session import scratch_path
from ..sources import fixtures as X
from ..sources import publish
from ..sources.catalog import basename, parse_names
from ..sources.footers import column_facts
from ..sources.sinks import append_column_log, read_column_log, read_unified, write_unified
from .audit import run_audit
from .explore import explore
from .ingest import ingest_frame, ingest_latest_frame, run_ingest

REFERENCE_DATE = "2024-01-20"
DETECTION_TIME = "2024-02-01 00:00:00"
LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
HISTORY_BUCKETS = 16
TEXT_SOURCE_RETAILERS = ["click", "view"]
OPTIONAL_DROPPED = ["Retailer_Website", "Currency", "Url"]
PRICES = ["Original_Price", "Sale_Price"]


# ---- shared inputs ---------------------------------------------------------

def _listing(spark, sf):
    return X.listing(spark, sf)


def _conformed(spark, sf):
    return conform_types(X.listing(spark, sf))


def _eda(spark, sf):
    return conform_types(X.listing_with_source(spark, sf), eda_schema(), fill_missing=True,
                         keep=[SOURCE_FILE])


def _catalog(spark, sf):
    return parse_names(X.file_names(spark, sf), X.EVENT_SOURCES)


def _rules(kind=None):
    rs = default_rules()
    return [r for r in rs if kind is None or r.kind == kind]


def _text(failed):
    return F.array_join(failed, ",")


# ---- scans, catalog --------------------------------------------------------

def q_scan_listing(spark, sf):
    """Listing rows as scanned."""
    return _listing(spark, sf)


def q_file_catalog(spark, sf):
    """File names parsed into the catalog."""
    return _catalog(spark, sf)


def q_file_basename(spark, sf):
    """Base name of a path."""
    return X.file_names(spark, sf).select("path", basename(F.col("path")).alias("file_name"))


def q_catalog_status(spark, sf):
    """Catalog entries counted by status."""
    return C.catalog_status_counts(_catalog(spark, sf))


def q_files_per_retailer(spark, sf):
    """Usable files per source."""
    return C.files_per_retailer(_catalog(spark, sf))


def q_latest_as_of(spark, sf):
    """Newest file per source on or before the date."""
    return C.latest_as_of(_catalog(spark, sf), REFERENCE_DATE)


def q_catalog_newest_first(spark, sf):
    """O1: files per source, newest first."""
    return C.newest_first(_catalog(spark, sf))


# ---- conformance -------------------------------------------------------------

def q_canonical_projection(spark, sf):
    """Canonical columns in canonical order."""
    df = _listing(spark, sf)
    shuffled = df.select(*reversed(df.columns[:9]), F.lit("x").alias("Promo_Code"), *df.columns[9:])
    return canonical_projection(shuffled)


def q_conform_types(spark, sf):
    """Canonical types, bad values null."""
    return _conformed(spark, sf)


def q_conform_integer(spark, sf):
    """P5: integer coercion."""
    df = _listing(spark, sf).select("Product_Name", "Product_ID", "Size_Or_Quantity")
    return conform_integer(df, ["Product_ID", "Size_Or_Quantity"])


def q_conform_fill_missing(spark, sf):
    """Absent canonical columns filled with typed nulls."""
    return conform_types(_listing(spark, sf).drop(*OPTIONAL_DROPPED), fill_missing=True)


def q_rows_per_source(spark, sf):
    """Rows per Source_File."""
    return (X.listing_with_source(spark, sf).groupBy(SOURCE_FILE)
            .agg(F.count(F.lit(1)).alias("rows")))


def q_union_conformed(spark, sf):
    """Conformed parts unioned by name."""
    df = _listing(spark, sf)
    full = df.where(F.col("Retailer").isin(TEXT_SOURCE_RETAILERS))
    thin = df.where(~F.col("Retailer").isin(TEXT_SOURCE_RETAILERS)).drop(*OPTIONAL_DROPPED)
    return union_conformed([full, thin])


# ---- schema checks -----------------------------------------------------------

def q_schema_missing(spark, sf):
    """Required columns a file lacks."""
    return S.schema_missing(X.file_schemas(spark, sf))


def q_schema_extra(spark, sf):
    """Columns outside the canonical schema."""
    return S.schema_extra(X.file_schemas(spark, sf))


def q_type_mismatch(spark, sf):
    """Incompatible column types per file."""
    return S.type_mismatch(X.file_schemas(spark, sf))


def q_schema_groups(spark, sf):
    """Files grouped by ordered (name, type) list."""
    return S.schema_groups(X.file_schemas(spark, sf))


def q_schema_listing(spark, sf):
    """Schema as rows."""
    return S.schema_listing(spark, _conformed(spark, sf)).drop("nullable")


# ---- rules and gate ------------------------------------------------------------

def _quarantine_pairs(spark, sf, kind):
    g = gate(_listing(spark, sf), _rules(kind))
    return g.quarantine().select("Product_Name", F.explode("failed_rules").alias("rule_id"))


def q_rule_not_null(spark, sf):
    """Q1: rows failing a not-null rule."""
    return _quarantine_pairs(spark, sf, "not_null")


def q_rule_unique(spark, sf):
    """Q2: rows failing the uniqueness rule."""
    g = gate(_listing(spark, sf), _rules("unique"))
    return g.quarantine().select("Product_Name", "Product_ID")


def q_rule_between(spark, sf):
    """Q3: rows failing a range rule."""
    return _quarantine_pairs(spark, sf, "between")


def q_gate_failed_rules(spark, sf):
    """Q4: failed rules of every row."""
    g = gate(_listing(spark, sf), _rules())
    return g.flagged().select("Product_Name", _text(F.col("failed_rules")).alias("failed_rules"))


def q_gate_survivors(spark, sf):
    """Q5: surviving rows, conformed."""
    g = gate(_listing(spark, sf), _rules(), required=required_names())
    return conform_types(g.survivors())


def q_gate_quarantine(spark, sf):
    """Q6: rows that do not survive."""
    g = gate(_listing(spark, sf), _rules())
    q = g.quarantine()
    return q.select(*[c for c in q.columns if c != "failed_rules"],
                    _text(F.col("failed_rules")).alias("failed_rules"))


def q_rule_report(spark, sf):
    """Per-rule result of the one-file gate."""
    return gate(_listing(spark, sf), _rules()).rule_report()


MIXED_RULES = {"expectations": [
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Shelf", "mostly": 0.9}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Shelf", "mostly": 0.95}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Aisle"}},
    {"expectation_type": "ExpectColumnMedianToBeBetween", "kwargs": {"column": "Sale_Price"}},
    {"expectation_type": "ExpectColumnValuesToBeBetween",
     "kwargs": {"column": "Original_Price", "min_value": 4, "max_value": 5760}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull"},
]}


def q_rule_report_mixed(spark, sf):
    """Rules that pass by ``mostly`` (a tenth of the rows fails), fail, are skipped, or cannot run."""
    shelf = F.when(~F.col("Product_Name").endswith("0"), F.lit("a")).alias("Shelf")
    df = _listing(spark, sf).select("*", shelf)
    return gate(df, parse_rules(MIXED_RULES), on_type_error="error").rule_report()


def q_rule_report_per_file(spark, sf):
    """A5: per-rule result per file."""
    return gate(_listing(spark, sf), _rules(), file_col="Retailer").rule_report()


def q_file_verdict(spark, sf):
    """Accept / repair / reject per file."""
    return gate(_listing(spark, sf), _rules(), file_col="Retailer",
                required=required_names()).verdicts()


# ---- written constraints ---------------------------------------------------------

def q_constraint_missing_rate(spark, sf):
    """Q11: missing-rate constraints."""
    return K.missing_rates(_conformed(spark, sf), MISSING_RATE_LIMITS)


def q_constraint_json_rate(spark, sf):
    """JSON-validity constraints."""
    return K.json_rates(_listing(spark, sf), JSON_RATE_FLOORS)


def q_constraint_unique_per_group(spark, sf):
    """Q13: unique id per retailer."""
    return K.unique_per_group(_listing(spark, sf), ["Retailer"], "Product_ID")


def q_derive_range_bounds(spark, sf):
    """Bounds from observed min/max with tolerance."""
    return P.price_bounds(_eda(spark, sf), PRICES, RANGE_TOLERANCE)


def q_json_extract(spark, sf):
    """fields out of JSON text."""
    df = _listing(spark, sf)
    return df.select(
        "Product_Name",
        F.try_variant_get(F.try_parse_json("Store_Info"), "$.store_id", "bigint").alias("store_id"),
        F.try_variant_get(F.try_parse_json("Variant_Info"), "$.k", "bigint").alias("variant_k"))


JSON_COLUMNS = ["Store_Info", "Variant_Info"]


def q_json_structure(spark, sf):
    """Every path in the JSON columns, with types and counts."""
    return J.json_paths(_listing(spark, sf), JSON_COLUMNS)


def q_json_columns(spark, sf):
    """a column for every path that was found."""
    return J.extract_json(_listing(spark, sf).select("Product_Name", *JSON_COLUMNS), JSON_COLUMNS)


# ---- ingest and sinks -------------------------------------------------------------

def q_ingest_file(spark, sf):
    """Every file gated and conformed."""
    return ingest_frame(X.listing_with_source(spark, sf), _rules()).unified


def q_ingest_unified(spark, sf):
    """Newest file per source, gated, conformed."""
    return ingest_latest_frame(X.listing_with_source(spark, sf), _rules(),
                               sources=X.EVENT_SOURCES, reference_date=REFERENCE_DATE).unified


def q_ingest_folder(spark, sf):
    """A landing folder ingested whole; its path holds a blank and repeats its last name."""
    base = scratch_path(spark, "folder")
    root = base + "/admin/in/a b/in"
    df = _listing(spark, sf)
    for source in X.EVENT_SOURCES:
        df.where(F.col("Retailer") == source).write.parquet(f"{root}/{source}_weekly_20240108_000000.parquet")
    run_ingest(spark, root, base + "/unified", _rules(), reference_date=REFERENCE_DATE, sources=X.EVENT_SOURCES)
    return spark.read.parquet(base + "/unified")


def _odd():
    return F.substring_index("Product_Name", " ", -1).cast("long") % 2 == 1


def q_ingest_drift(spark, sf):
    """Entries whose parts differ. Of click the odd rows lack Url, of view the even ones have a
    column more, purchase has a number in two widths, signup prices as text and as numbers (rejected whole)."""
    base = scratch_path(spark, "drift")
    df = _listing(spark, sf)
    prices = {c: F.expr(f"try_cast({c} AS double)") for c in PRICES}
    same = (lambda d: d, lambda d: d)
    parts = {
        "click": (lambda d: d.drop("Url"), lambda d: d),
        "view": (lambda d: d, lambda d: d.withColumn("Promo_Code", F.lit("x"))),
        "purchase": (lambda d: d.withColumn("Size_Or_Quantity", F.col("Size_Or_Quantity").cast("int")),
                     lambda d: d.withColumn("Size_Or_Quantity", F.col("Size_Or_Quantity").cast("bigint"))),
        "signup": (lambda d: d.withColumns(prices), lambda d: d),
    }
    for source in X.EVENT_SOURCES:
        rows = df.where(F.col("Retailer") == source)
        odd, even = parts.get(source, same)
        path = f"{base}/in/{source}_weekly_20240108_000000.parquet"
        odd(rows.where(_odd())).write.parquet(path)
        even(rows.where(~_odd())).write.mode("append").parquet(path)
    run_ingest(spark, base + "/in", base + "/unified", _rules(), reference_date=REFERENCE_DATE, sources=X.EVENT_SOURCES)
    return spark.read.parquet(base + "/unified")


def _published(spark, sf):
    """A folder published twice over: first a file that holds half of click, then all files, then all again;
    beside them what a run left that ended before its commit."""
    base = scratch_path(spark, "replay")
    df = _listing(spark, sf)
    name = "{}_weekly_20240108_000000.parquet".format
    df.where((F.col("Retailer") == "click") & _odd()).write.parquet(f"{base}/first/{name('click')}")
    for source in X.EVENT_SOURCES:
        df.where(F.col("Retailer") == source).write.parquet(f"{base}/second/{name(source)}")
    for folder in ("first", "second", "second"):
        run_ingest(spark, f"{base}/{folder}", base + "/unified", _rules(), reference_date=REFERENCE_DATE,
                   sources=X.EVENT_SOURCES, quarantine_path=base + "/quarantine", once=True)
    lost = conform_types(df.withColumn(SOURCE_FILE, F.lit(name("click"))), keep=[SOURCE_FILE])
    publish.stage(lost.where(F.col("Retailer") == "click"), base + "/unified", "lost", SOURCE_FILE)
    return base


def q_ingest_replay(spark, sf):
    """The rows of files published several times over, each once."""
    return read_unified(spark, _published(spark, sf) + "/unified")


def q_ingest_quarantine(spark, sf):
    """What did not survive a published ingest, raw values as text, by the manifest of the unified table."""
    base = _published(spark, sf)
    names = conform_types(_listing(spark, sf)).columns
    schema = StructType([StructField(c, StringType()) for c in names] + [StructField("failed_rules", ArrayType(StringType()))])
    rows = publish.read_published(spark, base + "/quarantine", schema, manifest_of=base + "/unified")
    return rows.withColumn("failed_rules", _text(F.col("failed_rules")))


def q_sink_unified(spark, sf):
    """Append twice (a rerun) and read back."""
    path = scratch_path(spark, "unified")
    out = q_ingest_unified(spark, sf)
    write_unified(out, path)   # first run creates the table
    write_unified(out, path)   # a rerun appends (no key check), like the reference
    return spark.read.schema(out.schema).parquet(path)


def q_column_log(spark, sf):
    """Column-change log appended and read."""
    path = scratch_path(spark, "column-log")
    schemas = X.file_schemas(spark, sf)
    rows = S.new_column_log(schemas, DETECTION_TIME)
    # two appends (e.g. two weekly runs) read back as one log
    append_column_log(rows.where(F.col("file_name") < "purchase"), path)
    append_column_log(rows.where(~(F.col("file_name") < "purchase")), path)
    return read_column_log(spark, path)


# ---- audit ---------------------------------------------------------------------------

def _lineitem(spark, sf):
    return X.table(spark, sf, "lineitem")


def q_duplicate_summary(spark, sf):
    """A1-A3: total, unique and duplicate records."""
    return A.duplicate_summary(_lineitem(spark, sf), LINEITEM_KEYS)


def q_duplicate_rows(spark, sf):
    """First duplicated rows."""
    return A.duplicate_rows(_lineitem(spark, sf), LINEITEM_KEYS, limit=10)


def q_duplicate_sample(spark, sf):
    """First duplicated keys."""
    return A.duplicate_sample(_lineitem(spark, sf), LINEITEM_KEYS, limit=5)


def q_dedupe_by_key(spark, sf):
    """U4: one row per key."""
    return A.dedupe_by_key(_lineitem(spark, sf), LINEITEM_KEYS)


HISTORY_WEEKS = ["1996-01-01", "1997-01-01"]


def q_key_history(spark, sf):
    """Q2, A2, A3: keys of the newest rows against the keys of two earlier batches (the second added twice)."""
    df = _lineitem(spark, sf)
    history = KeyHistory(spark, scratch_path(spark, "key-history"), {k: df.schema[k].dataType.simpleString() for k in LINEITEM_KEYS},
                         buckets=HISTORY_BUCKETS)
    first, second = (F.lit(d).cast("timestamp_ntz") for d in HISTORY_WEEKS)
    history.add(df.where(F.col("l_shipdate") < first), "1")
    for _ in range(2):
        history.add(df.where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < second)), "2")
    return history.lookup(df.where(F.col("l_shipdate") >= second))


def q_audit_null_counts(spark, sf):
    """A4, Q9: nulls in required columns."""
    return A.null_counts(_conformed(spark, sf))


def q_audit_overall(spark, sf):
    """The whole audit."""
    return A.audit(_conformed(spark, sf))


def q_audit_table(spark, sf):
    """Audit of a table path (a column missing, one of a wrong type, rows twice), report read back."""
    base = scratch_path(spark, "audit")
    df = _conformed(spark, sf).drop("Brand").withColumn("In_Stock", F.col("In_Stock").cast("string"))
    df.unionAll(df.where(F.col("Retailer") == "view")).write.parquet(base + "/table")
    run_audit(spark, base + "/table", report_path=base + "/report")
    report = spark.read.text(base + "/report", wholetext=True)
    paths = {
        "schema_passed": ("schema_validation.passed", "boolean"),
        "missing_columns": ("schema_validation.details.missing_columns", "string"),
        "types_passed": ("data_type_validation.passed", "boolean"),
        "mismatched_column": ("data_type_validation.details.type_mismatches[0].column", "string"),
        "actual_type": ("data_type_validation.details.type_mismatches[0].actual_type", "string"),
        "duplicates_passed": ("duplicate_check.passed", "boolean"),
        "total_records": ("duplicate_check.details.total_records", "bigint"),
        "unique_records": ("duplicate_check.details.unique_records", "bigint"),
        "duplicate_records": ("duplicate_check.details.duplicate_records", "bigint"),
        "nulls_passed": ("null_check.passed", "boolean"),
        "null_ids": ("null_check.details.null_counts.Product_ID", "bigint"),
        "null_categories": ("null_check.details.null_counts.Category_Traversal", "bigint"),
        "overall_passed": ("overall_passed", "boolean"),
    }
    return report.select(*[F.get_json_object("value", "$." + p).cast(t).alias(n) for n, (p, t) in paths.items()])


def q_preview_rows(spark, sf):
    """Ordered preview."""
    return A.preview(_conformed(spark, sf), 20, ["Run_Date", "Retailer", "Product_Name"])


# ---- profile ----------------------------------------------------------------------------

def q_profile_missing(spark, sf):
    """Missing values per column."""
    return P.missing(_eda(spark, sf))


def q_profile_constant(spark, sf):
    """A10: constant columns."""
    return P.constant_columns(_eda(spark, sf))


FOOTER_TABLES = ["lineitem", "events"]


def _from_footers(spark, sf, found):
    """``found(df, facts)`` of each table, with its name."""
    parts = []
    for name in FOOTER_TABLES:
        path = f"{sf.rstrip('/')}/{name}.parquet"
        part = found(spark.read.parquet(path), column_facts(spark, path))
        parts.append(part.select(F.lit(name).alias("table"), *part.columns))
    return parts[0].unionAll(parts[1])


def q_footer_missing(spark, sf):
    """Missing values per column, from footers where they tell them."""
    return _from_footers(spark, sf, P.missing)


def q_footer_constant(spark, sf):
    """A10: constant columns, from footers where they tell the bounds."""
    return _from_footers(spark, sf, lambda df, known: P.constant_columns(df.withColumn("kind", F.lit("x")), known))


def q_footer_bounds(spark, sf):
    """Bounds of every number, from footers where they tell them."""
    return _from_footers(spark, sf, lambda df, known: P.price_bounds(
        df, [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)], RANGE_TOLERANCE, known))


def q_profile_dataset(spark, sf):
    """Dataset summary."""
    return P.dataset_summary(_eda(spark, sf))


def q_profile_kinds(spark, sf):
    """Variable kinds."""
    return P.kinds(_eda(spark, sf))


def q_profile_kind_counts(spark, sf):
    """Variables per kind."""
    return P.kind_counts(P.kinds(_eda(spark, sf)))


def q_profile_corr_numeric(spark, sf):
    """Numeric correlation."""
    return P.numeric_correlation(_eda(spark, sf)).withColumn("corr", F.round("corr", 6))


def q_profile_assoc_categorical(spark, sf):
    """Cramér's V between text and boolean columns."""
    df = _eda(spark, sf)
    cols = P.association_columns(df)
    return P.categorical_association(df, cols).withColumn("cramers_v", F.round("cramers_v", 6))


def q_profile_weeks(spark, sf):
    """A9, A13, A14, A16 over weeks: the profile merged from one kept state per week (its exact part)."""
    df = _eda(spark, sf).drop(SOURCE_FILE)
    state = WeeklyProfile(spark, scratch_path(spark, "weeks"))
    weeks = [r["w"] for r in df.select(F.date_format("Run_Date", "yyyyMMdd").alias("w")).distinct().orderBy("w").collect()]
    for week in weeks:   # as they come in, one by one
        state.add(df.where(F.date_format("Run_Date", "yyyyMMdd") == week), week)
    return state.merged().select("column", "rows", "n_missing", "low", "high",
                                 F.when(F.col("distinct_exact"), F.col("n_distinct")).alias("n_distinct"))


def q_explore_profile(spark, sf):
    """A folder of three schemas explored (grouped, normalized, united) and profiled."""
    root = scratch_path(spark, "explore")
    df = _listing(spark, sf)
    for source in X.EVENT_SOURCES:
        part = df.where(F.col("Retailer") == source)
        if source == "error":
            part = part.drop("Currency")
        if source == "purchase":
            part = part.withColumns({c: F.expr(f"try_cast({c} AS double)") for c in PRICES})
        part.write.parquet(f"{root}/{source}_weekly_20240108_000000.parquet")
    found = explore(spark, root, X.EVENT_SOURCES)
    groups = found.groups.count()
    return P.dataset_summary(found.unified).select(
        F.lit(groups).cast("long").alias("schema_groups"), "rows", "variables", "missing_cells", "duplicate_rows")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
