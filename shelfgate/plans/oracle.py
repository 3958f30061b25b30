"""Independent SQL (DuckDB dialect) for every registered query.

The views mirror :mod:`shelfgate.sources.fixtures` expression by expression;
the checks are written the plain SQL way (windows, ``IN`` sub-queries,
``UNION ALL``), not the way the Spark plans compute them, so the two sides
are independent. Rules, limits, dates and the file-name pattern are written
out here and not taken from the code they check.
"""

from __future__ import annotations

from collections import namedtuple
from itertools import combinations

from ..functions.schema import CANONICAL, required_names
from ..sources.fixtures import LANDING_DIR, NEGATIVE_FILE_NAMES
from .queries import OPTIONAL_DROPPED, PRICES, TEXT_SOURCE_RETAILERS

REFERENCE_DATE = "2024-01-20"
DETECTION_TIME = "2024-02-01 00:00:00"
PAT = r"^(click|error|purchase|signup|view)_weekly_(\d{8})_(\d{6})\.parquet$"

# --- fixed values: the shipped rules in file order, and the written constraints
_Rule = namedtuple("_Rule", "position kind column min_value max_value")
RULES = [_Rule(*r) for r in [
    (1, "not_null", "Run_Date", None, None),
    (2, "not_null", "Retailer", None, None),
    (3, "not_null", "Store_Info", None, None),
    (4, "not_null", "Category_Traversal", None, None),
    (5, "not_null", "Brand", None, None),
    (6, "not_null", "Product_Name", None, None),
    (7, "unique", "Product_ID", None, None),
    (8, "not_null", "Variant_Info", None, None),
    (9, "not_null", "Size_Or_Quantity", None, None),
    (10, "between", "Original_Price", 4, 5760),
    (11, "between", "Sale_Price", 2.4, 9644.4),
    (12, "not_null", "In_Stock", None, None),
]]
RULE_TYPES = {"not_null": "ExpectColumnValuesToNotBeNull", "unique": "ExpectColumnValuesToBeUnique",
              "between": "ExpectColumnValuesToBeBetween"}
MISSING_RATE_LIMITS = {
    "Run_Date": 0.005, "Retailer": 0.005, "In_Stock": 0.005,
    "Brand": 0.01, "Product_Name": 0.01, "Size_Or_Quantity": 0.01,
    "Category_Traversal": 0.02, "Original_Price": 0.02, "Sale_Price": 0.02,
}
JSON_RATE_FLOORS = {"Store_Info": 1.0, "Variant_Info": 0.95}
RANGE_TOLERANCE = 0.2

NAMES = [f.name for f in CANONICAL.fields]
FLOAT_COLS = ["Number_Of_Reviews", "Average_Rating", "Original_Price", "Sale_Price"]

LISTING = """listing AS (
  SELECT date_trunc('week', ts) AS Run_Date,
    event_type AS Retailer,
    CASE WHEN user_id % 10 = 0 THEN NULL ELSE concat('https://', event_type, '.example') END AS Retailer_Website,
    concat('{"store_id": ', CAST(user_id AS VARCHAR), '}') AS Store_Info,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_type END AS Category_Traversal,
    event_type AS Brand,
    concat('unit ', CAST(event_id AS VARCHAR)) AS Product_Name,
    CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 50 = 1 THEN CAST(event_id - 1 AS VARCHAR)
         ELSE CAST(event_id AS VARCHAR) END AS Product_ID,
    CASE WHEN event_id % 5 = 0 THEN '' ELSE NULL END AS Universal_Product_ID,
    CASE WHEN event_id % 40 = 0 THEN '{bad' ELSE props END AS Variant_Info,
    CAST(user_id % 7 AS VARCHAR) AS Size_Or_Quantity,
    CAST(NULL AS VARCHAR) AS Number_Of_Reviews,
    CAST(NULL AS VARCHAR) AS Average_Rating,
    CASE WHEN event_id % 8 = 0 THEN NULL WHEN event_id % 30 = 7 THEN concat('$', CAST(value AS VARCHAR))
         ELSE CAST(value * 20 AS VARCHAR) END AS Original_Price,
    CAST(value * 12 AS VARCHAR) AS Sale_Price,
    'USD' AS Currency,
    concat('https://', event_type, '.example/', CAST(event_id AS VARCHAR)) AS Url,
    event_type <> 'error' AS In_Stock
  FROM events)"""

LISTING_SRC = """listing_src AS (
  SELECT *, concat(Retailer, '_weekly_', strftime(Run_Date, '%Y%m%d'), '_000000.parquet') AS Source_File
  FROM listing)"""


def _num(c: str, t: str = "FLOAT") -> str:
    inner = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return inner if t == "DOUBLE" else f"CAST({inner} AS {t})"


def _conformed_cols(src_alias: str = "", float_t: str = "FLOAT", nulls: tuple = ()) -> str:
    out = []
    for n in NAMES:
        c = f"{src_alias}{n}"
        if n in nulls:
            t = float_t if n in FLOAT_COLS else ("BOOLEAN" if n == "In_Stock" else
                                                  "TIMESTAMP" if n == "Run_Date" else "VARCHAR")
            out.append(f"CAST(NULL AS {t}) AS {n}")
        elif n in FLOAT_COLS:
            out.append(f"{_num(c, float_t)} AS {n}")
        else:
            out.append(f"{c} AS {n}")
    return ", ".join(out)


CONFORMED = f"conformed AS (SELECT {_conformed_cols()} FROM listing)"
EDA = f"eda AS (SELECT {_conformed_cols(float_t='DOUBLE')}, Source_File FROM listing_src)"

NAMES_CTE = (
    "names AS (SELECT concat('" + LANDING_DIR + "/', event_type, '_weekly_', strftime(ts, '%Y%m%d'), '_', "
    "strftime(ts, '%H%M%S'), '.parquet') AS path FROM events UNION ALL SELECT * FROM (VALUES "
    + ", ".join(f"('{LANDING_DIR}/{n}')" for n in NEGATIVE_FILE_NAMES) + ") v(path))"
)
CATALOG = f"""catalog AS (
  SELECT path, file_name,
    CASE WHEN regexp_matches(file_name, '{PAT}') THEN regexp_extract(file_name, '{PAT}', 1) END AS retailer,
    CASE WHEN regexp_matches(file_name, '{PAT}')
         THEN CAST(try_strptime(regexp_extract(file_name, '{PAT}', 2), '%Y%m%d') AS DATE) END AS file_date,
    CASE WHEN regexp_matches(file_name, '{PAT}') THEN regexp_extract(file_name, '{PAT}', 3) END AS file_time,
    CASE WHEN NOT regexp_matches(file_name, '{PAT}') THEN 'no_match'
         WHEN try_strptime(regexp_extract(file_name, '{PAT}', 2), '%Y%m%d') IS NULL THEN 'bad_date'
         ELSE 'ok' END AS status
  FROM (SELECT path, regexp_extract(path, '([^/]*)$', 1) AS file_name FROM names))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---- per-file schema fixture ---------------------------------------------------------
def _file_schemas_cte() -> str:
    cols = []
    pos = 0
    for f in CANONICAL.fields:
        pos += 1
        cols.append((pos, f.name))
        if f.name == "Url":
            pos += 1
            cols.append((pos, "Promo_Code"))
    values = ", ".join(f"{{'pos': {p}, 'name': '{n}'}}" for p, n in cols)
    type_case = "CASE c.name " + " ".join(
        f"WHEN '{f.name}' THEN '{f.dataType.simpleString()}'" for f in CANONICAL.fields) + " ELSE 'string' END"
    return f"""fs_files AS (
  SELECT event_id, event_type,
    concat(event_type, '_weekly_', strftime(ts, '%Y%m%d'), '_', strftime(ts, '%H%M%S'), '_',
           CAST(event_id AS VARCHAR), '.parquet') AS file_name
  FROM events),
fs_exp AS (SELECT event_id, event_type, file_name, unnest([{values}]) AS c FROM fs_files),
fs_raw AS (
  SELECT file_name, c.pos AS pos, c.name AS "column",
    CASE WHEN c.name IN ('Average_Rating', 'Original_Price', 'Sale_Price')
           THEN CASE WHEN event_type IN ('click', 'view') THEN 'string' ELSE 'double' END
         WHEN c.name = 'Number_Of_Reviews' THEN 'double'
         WHEN c.name = 'In_Stock' THEN CASE WHEN event_id % 79 = 0 THEN 'string' ELSE 'boolean' END
         WHEN c.name = 'Run_Date' THEN CASE WHEN event_id % 73 = 0 THEN 'date' ELSE 'timestamp' END
         ELSE {type_case} END AS type
  FROM fs_exp
  WHERE NOT (c.name = 'Brand' AND event_id % 97 = 0)
    AND NOT (c.name = 'Currency' AND event_id % 89 = 0)
    AND NOT (c.name = 'Promo_Code' AND event_id % 83 <> 0)),
file_schemas AS (
  SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY pos) AS ordinal, "column", type
  FROM fs_raw)"""


# ---- rule flags over a listing scope ------------------------------------------------------
def _flags_cte(file_expr: str, rules=RULES, src: str = "listing") -> str:
    """Per-row failure flags ``r1..rN`` (row fails the rule and the rule failed in its file)."""
    a_cols, b_cols = [], []
    for i, r in enumerate(rules):
        if r.kind == "unique":
            c = r.column
            a_cols.append(f"count(*) OVER (PARTITION BY {file_expr}, {c}) AS k{i}")
            a_cols.append(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY {file_expr}) AS z{i}")
            b_cols.append(f"max(CASE WHEN {c} IS NOT NULL AND k{i} > 1 THEN 1 ELSE 0 END) "
                          f"OVER (PARTITION BY {file_expr}) AS d{i}")
    flags = []
    for i, r in enumerate(rules):
        c = r.column
        if r.kind == "not_null":
            flags.append(f"({c} IS NULL) AS r{i}")
        elif r.kind == "unique":
            flags.append(f"(({c} IS NOT NULL AND k{i} > 1) OR ({c} IS NULL AND z{i} >= 2 AND d{i} = 1)) AS r{i}")
        elif r.kind == "between":
            v = _num(c, "DOUBLE")
            conds = []
            if r.min_value is not None:
                conds.append(f"{v} < {r.min_value!r}")
            if r.max_value is not None:
                conds.append(f"{v} > {r.max_value!r}")
            flags.append(f"coalesce(({' OR '.join(conds)}) AND NOT isnan({v}), false) AS r{i}")
    a = f"fa AS (SELECT *, {file_expr} AS _f{''.join(', ' + x for x in a_cols)} FROM {src})"
    b = f"fb AS (SELECT *{''.join(', ' + x for x in b_cols)} FROM fa)"
    ff = f"flags AS (SELECT *, {', '.join(flags)} FROM fb)"
    return ",\n".join([a, b, ff])


def _failed_text(rules=RULES) -> str:
    parts = ", ".join(f"CASE WHEN r{i} THEN '{r.kind}:{r.column}' END" for i, r in enumerate(rules))
    return f"concat_ws(',', {parts})"


def _any_failed(rules=RULES) -> str:
    return "(" + " OR ".join(f"r{i}" for i in range(len(rules))) + ")"


def _raw_cols(prefix: str = "") -> str:
    return ", ".join(prefix + n for n in NAMES)


# ---- individual queries ---------------------------------------------------------------------

def _gate_pairs(kind: str) -> str:
    rules = [r for r in RULES if r.kind == kind]
    sel = " UNION ALL ".join(
        f"SELECT Product_Name, '{r.kind}:{r.column}' AS rule_id FROM flags WHERE r{i}" for i, r in enumerate(rules))
    return _with(LISTING, _flags_cte("'<all>'", rules)) + sel


def _rule_report_sql(file_expr: str = "'<all>'") -> str:
    rows = []
    for i, r in enumerate(RULES):
        c = r.column
        if r.kind == "not_null":
            unexpected = f"count(*) FILTER (WHERE {c} IS NULL)"
        elif r.kind == "between":
            unexpected = f"count(*) FILTER (WHERE r{i})"
        else:
            unexpected = f"count(*) FILTER (WHERE r{i})"
        rows.append(
            f"SELECT CAST(_f AS VARCHAR) AS file, {r.position} AS position, '{r.kind}:{c}' AS rule_id, "
            f"'{RULE_TYPES[r.kind]}' AS expectation_type, '{c}' AS column, "
            f"CASE WHEN {unexpected} = 0 THEN 'pass' ELSE 'fail' END AS status, "
            f"{unexpected} = 0 AS success, {unexpected} AS unexpected_rows, '' AS reason FROM flags GROUP BY _f")
    return _with(LISTING, _flags_cte(file_expr)) + " UNION ALL ".join(rows)


def _verdict_sql(file_col: str, src_ctes: tuple, src: str) -> str:
    n_rules = " + ".join(
        f"CASE WHEN count(*) FILTER (WHERE r{i}) > 0 THEN 1 ELSE 0 END" for i in range(len(RULES)))
    return _with(*src_ctes, _flags_cte(file_col, RULES, src)) + f"""
SELECT file, rows, failing_rows, rows - failing_rows AS survivors, rules_failed,
  CASE WHEN failing_rows = 0 AND rules_failed = 0 THEN 'accept' WHEN failing_rows = 0 THEN 'reject'
       WHEN rows = failing_rows THEN 'reject' ELSE 'repair' END AS outcome,
  CASE WHEN failing_rows = 0 AND rules_failed = 0 THEN 'all rules pass' WHEN failing_rows = 0 THEN 'rule error'
       WHEN rows = failing_rows THEN 'no survivors' ELSE 'failing rows dropped' END AS reason
FROM (SELECT CAST(_f AS VARCHAR) AS file, count(*) AS rows, count(*) FILTER (WHERE {_any_failed()}) AS failing_rows,
             CAST({n_rules} AS BIGINT) AS rules_failed
      FROM flags GROUP BY _f)"""


def _ingest_sql(latest_only: bool) -> str:
    ctes = [LISTING, LISTING_SRC]
    src = "listing_src"
    if latest_only:
        ctes.append(f"""chosen AS (
  SELECT * FROM listing_src WHERE Source_File IN (
    SELECT Source_File FROM (
      SELECT Source_File, row_number() OVER (PARTITION BY Retailer ORDER BY Source_File DESC) AS rn
      FROM (SELECT DISTINCT Retailer, Source_File FROM listing_src
            WHERE CAST(Run_Date AS DATE) <= DATE '{REFERENCE_DATE}')) WHERE rn = 1))""")
        src = "chosen"
    ctes.append(_flags_cte("Source_File", RULES, src))
    ctes.append(f"bad_files AS (SELECT _f FROM flags GROUP BY _f HAVING count(*) FILTER (WHERE NOT {_any_failed()}) = 0)")
    return _with(*ctes) + f"SELECT {_conformed_cols()} FROM flags WHERE NOT {_any_failed()} AND _f NOT IN (SELECT _f FROM bad_files)"


def _assoc_sql() -> str:
    """Cramér's V over every pair of text/boolean columns with two levels or more."""
    cands = [n for n in NAMES + ["Source_File"] if n not in FLOAT_COLS and n != "Run_Date"]
    levels = " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(DISTINCT {c}) AS nd FROM eda" for c in cands)
    parts = []
    for a, b in combinations(cands, 2):
        parts.append(f"""SELECT '{a}' AS column_a, '{b}' AS column_b, CAST({a} AS VARCHAR) AS va, CAST({b} AS VARCHAR) AS vb
  FROM eda WHERE {a} IS NOT NULL AND {b} IS NOT NULL""")
    cells = ("cells AS (SELECT column_a, column_b, va, vb, count(*) AS n_ab FROM (" +
             " UNION ALL ".join(parts) + ") GROUP BY ALL)")
    lv = f"lv AS ({levels})"
    return _with(LISTING, LISTING_SRC, EDA, lv, cells) + """,
m AS (SELECT *, sum(n_ab) OVER (PARTITION BY column_a, column_b, va) AS n_a,
             sum(n_ab) OVER (PARTITION BY column_a, column_b, vb) AS n_b FROM cells
      WHERE column_a IN (SELECT col FROM lv WHERE nd >= 2)
        AND column_b IN (SELECT col FROM lv WHERE nd >= 2)),
p AS (SELECT column_a, column_b, sum(n_ab) AS n, sum(CAST(n_ab AS DOUBLE) * n_ab / (n_a * n_b)) AS s,
             count(DISTINCT va) AS r, count(DISTINCT vb) AS c FROM m GROUP BY column_a, column_b)
SELECT column_a, column_b,
  round(CASE WHEN least(r, c) - 1 > 0 THEN sqrt(greatest(n * (s - 1), 0.0) / (n * (least(r, c) - 1))) END, 6)
    AS cramers_v,
  CAST(n AS BIGINT) AS n FROM p"""


def _kinds_sql() -> str:
    eda_cols = NAMES + ["Source_File"]
    rows = []
    for n in eda_cols:
        f = next((x for x in CANONICAL.fields if x.name == n), None)
        t = f.dataType.simpleString() if f else "string"
        if t == "boolean":
            k = "'Boolean'"
        elif t == "timestamp":
            k = "'DateTime'"
        elif t == "float":
            k = "'Numeric'"
        else:
            k = "CASE WHEN count(DISTINCT {c}) <= 50 THEN 'Categorical' ELSE 'Text' END".format(c=n)
        rows.append(f"SELECT '{n}' AS column, CASE WHEN count({n}) = 0 THEN 'Unsupported' ELSE {k} END AS kind FROM eda")
    return _with(LISTING, LISTING_SRC, EDA) + " UNION ALL ".join(rows)


def _missing_sql() -> str:
    eda_cols = NAMES + ["Source_File"]
    rows = []
    for n in eda_cols:
        miss = f"{n} IS NULL" + (f" OR isnan({n})" if n in FLOAT_COLS else "")
        rows.append(f"SELECT '{n}' AS column, count(*) FILTER (WHERE {miss}) AS n_missing, "
                    f"count(*) FILTER (WHERE {miss}) * 100.0 / count(*) AS pct_missing FROM eda")
    return _with(LISTING, LISTING_SRC, EDA) + " UNION ALL ".join(rows)


def _dataset_sql() -> str:
    eda_cols = NAMES + ["Source_File"]
    miss = " + ".join(
        f"count(*) FILTER (WHERE {n} IS NULL" + (f" OR isnan({n}))" if n in FLOAT_COLS else ")") for n in eda_cols)
    nv = len(eda_cols)
    return _with(LISTING, LISTING_SRC, EDA) + f"""
SELECT rows, CAST({nv} AS BIGINT) AS variables, missing_cells, missing_cells * 100.0 / (rows * {nv}) AS missing_pct,
  rows - distinct_rows AS duplicate_rows, (rows - distinct_rows) * 100.0 / rows AS duplicate_pct
FROM (SELECT count(*) AS rows, CAST({miss} AS BIGINT) AS missing_cells,
             (SELECT count(*) FROM (SELECT DISTINCT * FROM eda)) AS distinct_rows FROM eda)"""


def _constant_sql() -> str:
    eda_cols = NAMES + ["Source_File"]
    rows = [f"SELECT '{n}' AS column FROM eda HAVING count(DISTINCT {n}) = 1" for n in eda_cols]
    return _with(LISTING, LISTING_SRC, EDA) + " UNION ALL ".join(rows)


def _corr_sql() -> str:
    rows = [f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({b}, {a}), 6) AS corr FROM eda"
            for a, b in combinations(FLOAT_COLS, 2)]
    return _with(LISTING, LISTING_SRC, EDA) + " UNION ALL ".join(rows)


def _audit_sql() -> str:
    req = required_names()
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS z_{c}" for c in req)
    text = ", ".join(f"CASE WHEN z_{c} > 0 THEN concat('{c}=', CAST(z_{c} AS VARCHAR)) END" for c in req)
    anyz = " OR ".join(f"z_{c} > 0" for c in req)
    return _with(LISTING, CONFORMED) + f"""
SELECT true AS schema_passed, '' AS missing_columns, '' AS extra_columns, true AS types_passed,
  '' AS type_mismatches, total_records, unique_records, total_records - unique_records AS duplicate_records,
  total_records = unique_records AS duplicates_passed, NOT ({anyz}) AS nulls_passed,
  concat_ws(',', {text}) AS null_counts,
  (total_records = unique_records) AND NOT ({anyz}) AS overall_passed
FROM (SELECT count(*) AS total_records,
             (SELECT count(*) FROM (SELECT DISTINCT Retailer, Store_Info, Product_ID, Run_Date FROM conformed))
               AS unique_records,
             {nulls} FROM conformed)"""


def _missing_rate_sql() -> str:
    rows = [f"SELECT '{c}' AS column, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS missing_rate, "
            f"CAST({lim!r} AS DOUBLE) AS max_missing_rate, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) <= {lim!r} AS passed "
            f"FROM conformed" for c, lim in MISSING_RATE_LIMITS.items()]
    return _with(LISTING, CONFORMED) + " UNION ALL ".join(rows)


def _json_rate_sql() -> str:
    rows = [f"SELECT '{c}' AS column, avg(CASE WHEN {c} IS NULL THEN NULL WHEN json_valid({c}) THEN 1 ELSE 0 END) "
            f"AS valid_rate, CAST({lim!r} AS DOUBLE) AS min_valid_rate, avg(CASE WHEN {c} IS NULL THEN NULL WHEN json_valid({c}) "
            f"THEN 1 ELSE 0 END) >= {lim!r} AS passed FROM listing" for c, lim in JSON_RATE_FLOORS.items()]
    return _with(LISTING) + " UNION ALL ".join(rows)


def _bounds_sql() -> str:
    lo, hi = 1 - RANGE_TOLERANCE, 1 + RANGE_TOLERANCE
    rows = [f"SELECT '{c}' AS column, min({c}) AS observed_min, max({c}) AS observed_max, "
            f"min({c}) * {lo!r} AS min_bound, max({c}) * {hi!r} AS max_bound FROM eda" for c in PRICES]
    return _with(LISTING, LISTING_SRC, EDA) + " UNION ALL ".join(rows)


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LI_REST = [c for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")]


def oracle_sql() -> dict[str, str]:
    L = _with(LISTING)
    LC = _with(LISTING, CONFORMED)
    FS = _with(_file_schemas_cte())
    CAT = _with(NAMES_CTE, CATALOG)
    req = required_names()
    canon = [f.name for f in CANONICAL.fields]
    expected_types = {f.name: f.dataType.simpleString() for f in CANONICAL.fields}
    exp_case = 'CASE "column" ' + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in expected_types.items()) + " END"
    fam = ("CASE {t} WHEN 'string' THEN 'string' WHEN 'double' THEN 'fractional' WHEN 'float' THEN 'fractional' "
           "WHEN 'timestamp' THEN 'timestamp' WHEN 'date' THEN 'date' WHEN 'boolean' THEN 'boolean' ELSE {t} END")
    sig = 'string_agg(concat("column", \':\', type), \',\' ORDER BY ordinal)'
    q: dict[str, str] = {}
    q["scan_listing"] = L + "SELECT * FROM listing"
    q["file_catalog"] = CAT + "SELECT * FROM catalog"
    q["file_basename"] = _with(NAMES_CTE) + "SELECT path, regexp_extract(path, '([^/]*)$', 1) AS file_name FROM names"
    q["catalog_status"] = CAT + "SELECT status, count(*) AS files FROM catalog GROUP BY status"
    q["files_per_retailer"] = CAT + "SELECT retailer, count(*) AS files FROM catalog WHERE status = 'ok' GROUP BY retailer"
    q["latest_as_of"] = CAT + f"""SELECT retailer, file_name, path, file_date, file_time FROM (
  SELECT *, row_number() OVER (PARTITION BY retailer ORDER BY file_date DESC, file_time DESC, file_name DESC) AS rn
  FROM catalog WHERE status = 'ok' AND file_date <= DATE '{REFERENCE_DATE}') WHERE rn = 1"""
    q["catalog_newest_first"] = CAT + ("SELECT retailer, file_name, path, file_date, file_time FROM catalog "
                                       "WHERE status = 'ok' ORDER BY retailer, file_date DESC, file_time DESC, file_name DESC")
    q["canonical_projection"] = L + "SELECT " + _raw_cols() + " FROM listing"
    q["conform_types"] = LC + "SELECT * FROM conformed"
    q["conform_integer"] = L + ("SELECT Product_Name, TRY_CAST(trim(Product_ID) AS BIGINT) AS Product_ID, "
                                "TRY_CAST(trim(Size_Or_Quantity) AS BIGINT) AS Size_Or_Quantity FROM listing")
    q["conform_fill_missing"] = L + f"SELECT {_conformed_cols(nulls=tuple(OPTIONAL_DROPPED))} FROM listing"
    q["rows_per_source"] = _with(LISTING, LISTING_SRC) + "SELECT Source_File, count(*) AS rows FROM listing_src GROUP BY 1"
    keep = ", ".join(
        (f"CASE WHEN Retailer IN ({', '.join(repr(r) for r in TEXT_SOURCE_RETAILERS)}) THEN {n} END AS {n}"
         if n in OPTIONAL_DROPPED else n) for n in canon)
    q["union_conformed"] = LC + f"SELECT {keep} FROM conformed"

    req_list = "[" + ", ".join(f"'{c}'" for c in req) + "]"
    q["schema_missing"] = FS + f"""SELECT file_name, unnest(list_filter({req_list}, lambda x: NOT list_contains(cols, x)))
  AS missing_column FROM (SELECT file_name, list("column") AS cols FROM file_schemas GROUP BY file_name)"""
    q["schema_extra"] = FS + 'SELECT file_name, "column" AS extra_column FROM file_schemas WHERE "column" NOT IN (' + \
        ", ".join(f"'{c}'" for c in canon) + ")"
    q["type_mismatch"] = FS + f"""SELECT file_name, "column", expected_type, actual_type FROM (
  SELECT file_name, "column", {exp_case} AS expected_type, type AS actual_type FROM file_schemas)
WHERE expected_type IS NOT NULL AND NOT (lower(actual_type) = lower(expected_type)
  OR {fam.format(t='actual_type')} = {fam.format(t='expected_type')}
  OR ({fam.format(t='actual_type')} = 'timestamp' AND {fam.format(t='expected_type')} = 'date'))"""
    q["schema_groups"] = FS + f"""SELECT sha256(signature) AS schema_group, count(*) AS n_files,
  n_columns, min(file_name) AS first_file, signature
FROM (SELECT file_name, count(*) AS n_columns, {sig} AS signature FROM file_schemas GROUP BY file_name)
GROUP BY signature, n_columns"""
    q["schema_listing"] = "SELECT * FROM (VALUES " + ", ".join(
        f"({i + 1}, '{f.name}', '{f.dataType.simpleString()}')" for i, f in enumerate(CANONICAL.fields)
    ) + ') v(ordinal, "column", type)'

    q["rule_not_null"] = _gate_pairs("not_null")
    q["rule_between"] = _gate_pairs("between")
    uq = [r for r in RULES if r.kind == "unique"]
    q["rule_unique"] = _with(LISTING, _flags_cte("'<all>'", uq)) + "SELECT Product_Name, Product_ID FROM flags WHERE r0"
    q["gate_failed_rules"] = _with(LISTING, _flags_cte("'<all>'")) + f"SELECT Product_Name, {_failed_text()} AS failed_rules FROM flags"
    q["gate_survivors"] = _with(LISTING, _flags_cte("'<all>'")) + f"SELECT {_conformed_cols()} FROM flags WHERE NOT {_any_failed()}"
    q["gate_quarantine"] = _with(LISTING, _flags_cte("'<all>'")) + \
        f"SELECT {_raw_cols()}, {_failed_text()} AS failed_rules FROM flags WHERE {_any_failed()}"
    q["rule_report"] = _rule_report_sql()
    q["rule_report_mixed"] = """
WITH s AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 10 = 0) AS bad FROM events)
SELECT '<all>' AS file, 1 AS position, 'not_null:Shelf' AS rule_id,
  'ExpectColumnValuesToNotBeNull' AS expectation_type, 'Shelf' AS "column",
  CASE WHEN 10 * bad <= n THEN 'pass' ELSE 'fail' END AS status, 10 * bad <= n AS success,
  bad AS unexpected_rows, '' AS reason FROM s
UNION ALL SELECT '<all>', 2, 'not_null:Shelf', 'ExpectColumnValuesToNotBeNull', 'Shelf',
  CASE WHEN 20 * bad <= n THEN 'pass' ELSE 'fail' END, 20 * bad <= n, bad, '' FROM s
UNION ALL VALUES
  ('<all>', 3, 'not_null:Aisle', 'ExpectColumnValuesToNotBeNull', 'Aisle', 'skipped', true, 0, 'column not in data'),
  ('<all>', 4, 'unknown:Sale_Price', 'ExpectColumnMedianToBeBetween', 'Sale_Price', 'skipped', true, 0,
   'unsupported rule type'),
  ('<all>', 5, 'between:Original_Price', 'ExpectColumnValuesToBeBetween', 'Original_Price', 'error', false, 0,
   'cannot compare string with a number'),
  ('<all>', 6, 'not_null:None', 'ExpectColumnValuesToNotBeNull', NULL, 'error', false, 0, 'rule names no column')"""
    q["rule_report_per_file"] = _rule_report_sql("Retailer")
    q["file_verdict"] = _verdict_sql("Retailer", (LISTING,), "listing")

    q["constraint_missing_rate"] = _missing_rate_sql()
    q["constraint_json_rate"] = _json_rate_sql()
    q["constraint_unique_per_group"] = L + """SELECT Retailer, CAST(sum(n) AS BIGINT) AS ids, count(*) AS distinct_ids,
  count(*) FILTER (WHERE n > 1) AS duplicated_ids, count(*) FILTER (WHERE n > 1) = 0 AS passed
FROM (SELECT Retailer, Product_ID, count(*) AS n FROM listing WHERE Product_ID IS NOT NULL GROUP BY ALL) GROUP BY Retailer"""
    q["derive_range_bounds"] = _bounds_sql()
    q["json_extract"] = L + """SELECT Product_Name,
  CASE WHEN json_valid(Store_Info) THEN TRY_CAST(json_extract_string(Store_Info, '$.store_id') AS BIGINT) END AS store_id,
  CASE WHEN json_valid(Variant_Info) THEN TRY_CAST(json_extract_string(Variant_Info, '$.k') AS BIGINT) END AS variant_k
FROM listing"""

    q["ingest_file"] = _ingest_sql(False)
    q["ingest_folder"] = (_with(LISTING, _flags_cte("Retailer"))
                          + f"SELECT {_conformed_cols()} FROM flags WHERE NOT {_any_failed()}")
    q["ingest_drift"] = (_with(LISTING, _flags_cte("Retailer")) + f"""
SELECT * REPLACE (CASE WHEN Retailer = 'click' AND CAST(split_part(Product_Name, ' ', 2) AS BIGINT) % 2 = 1 THEN NULL
                       ELSE Url END AS Url)
FROM (SELECT {_conformed_cols()} FROM flags WHERE NOT {_any_failed()} AND Retailer <> 'signup')""")
    q["ingest_replay"] = q["ingest_folder"]
    q["ingest_quarantine"] = _with(LISTING, _flags_cte("Retailer")) + (
        "SELECT " + ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in NAMES)
        + f", {_failed_text()} AS failed_rules FROM flags WHERE {_any_failed()}")
    q["ingest_unified"] = _ingest_sql(True)
    q["sink_unified"] = "SELECT * FROM (" + _ingest_sql(True) + ") UNION ALL SELECT * FROM (" + _ingest_sql(True) + ")"
    q["column_log"] = FS + (f"SELECT file_name, \"column\" AS new_column, TIMESTAMP '{DETECTION_TIME}' AS detection_time "
                            "FROM file_schemas WHERE \"column\" = 'Promo_Code'")

    li_cols = ", ".join(LINEITEM_COLS)
    q["duplicate_summary"] = """SELECT count(*) AS total_records, count(DISTINCT (l_orderkey, l_linenumber)) AS unique_records,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_records,
  count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS passed FROM lineitem"""
    q["duplicate_rows"] = f"""SELECT {li_cols}, dup_count FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dup_count FROM lineitem)
WHERE dup_count > 1 ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, {', '.join(c + ' NULLS FIRST' for c in LI_REST)} LIMIT 10"""
    q["duplicate_sample"] = """SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem GROUP BY ALL
HAVING count(*) > 1 ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST LIMIT 5"""
    q["dedupe_by_key"] = f"""SELECT {li_cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' NULLS FIRST' for c in LI_REST)}) AS rn
  FROM lineitem) WHERE rn = 1"""
    q["audit_null_counts"] = LC + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) AS null_count FROM conformed WHERE {c} IS NULL HAVING count(*) > 0" for c in req)
    q["audit_overall"] = _audit_sql()
    q["audit_table"] = LC + """, t AS (
  SELECT * FROM conformed UNION ALL SELECT * FROM conformed WHERE Retailer = 'view'),
u AS (SELECT count(*) AS n FROM (SELECT DISTINCT Retailer, Store_Info, Product_ID, Run_Date FROM t))
SELECT false AS schema_passed, '["Brand"]' AS missing_columns, false AS types_passed,
  'In_Stock' AS mismatched_column, 'string' AS actual_type, count(*) = any_value(n) AS duplicates_passed,
  count(*) AS total_records, any_value(n) AS unique_records, count(*) - any_value(n) AS duplicate_records,
  false AS nulls_passed, count(*) FILTER (WHERE Product_ID IS NULL) AS null_ids,
  count(*) FILTER (WHERE Category_Traversal IS NULL) AS null_categories, false AS overall_passed
FROM t, u"""
    q["preview_rows"] = LC + "SELECT * FROM conformed ORDER BY Run_Date, Retailer, Product_Name LIMIT 20"

    q["profile_missing"] = _missing_sql()
    q["profile_constant"] = _constant_sql()
    q["profile_dataset"] = _dataset_sql()
    # files of error lack Currency, those of purchase hold prices as doubles
    q["explore_profile"] = _with(LISTING, LISTING_SRC, EDA, "e AS (SELECT * REPLACE (CASE WHEN Retailer <> 'error' "
                                 "THEN Currency END AS Currency) FROM eda)") + f"""
SELECT CAST(3 AS BIGINT) AS schema_groups, count(*) AS rows, CAST({len(NAMES) + 1} AS BIGINT) AS variables,
  CAST(count(*) * {len(NAMES) + 1} - ({' + '.join(f'count({n})' for n in NAMES + ['Source_File'])}) AS BIGINT) AS missing_cells,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM e)) AS duplicate_rows FROM e"""
    parts = []
    for n in NAMES:
        number = n in FLOAT_COLS
        text = not number and n != "Run_Date"
        gone = f"{n} IS NULL OR isnan({n})" if number else f"{n} IS NULL"
        low, high = ((f"{f}({n}) FILTER (NOT isnan({n}))" for f in ("min", "max")) if number
                     else ("CAST(NULL AS DOUBLE)",) * 2)
        levels = (f"CASE WHEN (SELECT max(d) FROM (SELECT count(DISTINCT {n}) AS d FROM eda GROUP BY Run_Date)) <= 50 "
                  f"THEN count(DISTINCT {n}) END") if text else "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT '{n}' AS \"column\", count(*) AS rows, count(*) FILTER ({gone}) AS n_missing, {low} AS low, "
                     f"{high} AS high, {levels} AS n_distinct FROM eda")
    q["profile_weeks"] = _with(LISTING, LISTING_SRC, EDA) + "\nUNION ALL ".join(parts)
    q["key_history"] = """
WITH past AS (SELECT l_orderkey, l_linenumber, count(*) AS n_before FROM lineitem WHERE l_shipdate < '1997-01-01' GROUP BY ALL),
week AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_shipdate >= '1997-01-01' GROUP BY ALL)
SELECT l_orderkey, l_linenumber, n, coalesce(n_before, 0) AS n_before FROM week LEFT JOIN past USING (l_orderkey, l_linenumber)"""
    q["json_structure"] = _with(LISTING) + """, t AS (
  SELECT 'Store_Info' AS "column", Store_Info AS x FROM listing UNION ALL SELECT 'Variant_Info', Variant_Info FROM listing),
v AS (SELECT "column", '$' AS path, x, json_valid(x) AS ok FROM t WHERE x IS NOT NULL),
m AS (SELECT "column", unnest(json_keys(x)) AS k, x FROM v WHERE ok AND json_type(x) = 'OBJECT'),
a AS (
  SELECT "column", path, CASE WHEN NOT ok THEN 'INVALID' ELSE json_type(CASE WHEN ok THEN x END) END AS kind FROM v
  UNION ALL SELECT "column", concat('$.', k), json_type(json_extract(x, concat('$."', k, '"'))) FROM m)
SELECT "column", path, CASE kind WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID'
                                 ELSE kind END AS type, count(*) AS n_values
FROM a GROUP BY ALL"""
    q["json_columns"] = _with(LISTING) + """
SELECT Product_Name, Store_Info, Variant_Info,
  TRY_CAST(CASE WHEN json_valid(Store_Info) THEN json_extract_string(Store_Info, '$.store_id') END AS BIGINT) AS "Store_Info.store_id",
  TRY_CAST(CASE WHEN json_valid(Variant_Info) THEN json_extract_string(Variant_Info, '$.k') END AS BIGINT) AS "Variant_Info.k"
FROM listing"""
    li = {c: c not in ("l_returnflag", "l_linestatus", "l_shipdate") for c in LINEITEM_COLS}
    ev = {c: c in ("event_id", "user_id", "value") for c in ("event_id", "ts", "user_id", "event_type", "value", "props")}
    miss, bounds = [], []
    for t, cols in (("lineitem", li), ("events", ev)):
        for c, number in cols.items():
            gone = f"count(*) FILTER (WHERE {c} IS NULL{f' OR isnan(CAST({c} AS DOUBLE))' if number else ''})"
            miss.append(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {gone} AS n_missing, "
                        f"{gone} * 100.0::DOUBLE / count(*) AS pct_missing FROM {t}")
            if number:
                lo, hi = (f"CAST({f}({c}) AS DOUBLE)" for f in ("min", "max"))
                bounds.append(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {lo} AS observed_min, {hi} AS observed_max, "
                              f"{lo} * (1 - {RANGE_TOLERANCE}::DOUBLE) AS min_bound, "
                              f"{hi} * (1 + {RANGE_TOLERANCE}::DOUBLE) AS max_bound FROM {t}")
    q["footer_missing"] = " UNION ALL ".join(miss)
    q["footer_bounds"] = " UNION ALL ".join(bounds)
    q["footer_constant"] = " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\" FROM {t} HAVING count(DISTINCT {c}) = 1"
        for t, cols in (("lineitem", li), ("events", ev)) for c in cols) + " UNION ALL " + " UNION ALL ".join(
        f"SELECT '{t}', 'kind' FROM {t} HAVING count(*) > 0" for t in ("lineitem", "events"))
    q["profile_kinds"] = _kinds_sql()
    q["profile_kind_counts"] = ("SELECT kind, count(*) AS variables FROM (" + _kinds_sql() + ") GROUP BY kind")
    q["profile_corr_numeric"] = _corr_sql()
    q["profile_assoc_categorical"] = _assoc_sql()
    return q
