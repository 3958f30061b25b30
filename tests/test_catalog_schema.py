"""Catalog parsing, latest-as-of, rule files, schema checks, type families."""

from __future__ import annotations

import json
import tempfile

from shelfgate.functions.schema import types_compatible
from shelfgate.operators import catalog as C
from shelfgate.operators import schema_checks as S
from shelfgate.operators.rules import DEFAULT_RULE_CONFIG, default_rules, read_rules_json
from shelfgate.sources.catalog import DEFAULT_SOURCES, parse_names


def _catalog(spark, names):
    return parse_names(spark.createDataFrame([(f"/in/{n}",) for n in names], "path string"), DEFAULT_SOURCES)


def test_parse_names_status(spark):
    names = ["cubesmart_weekly_20250127_181344.parquet", "storagemart_weekly_20251399_101010.parquet",
             "cubesmart_weekly_20250127.parquet", "cubesmart_weekly_20250127_181344.csv",
             "nobody_weekly_20250127_181344.parquet"]
    st = {r["file_name"]: (r["status"], r["retailer"]) for r in _catalog(spark, names).collect()}
    assert st[names[0]] == ("ok", "cubesmart")
    assert st[names[1]] == ("bad_date", "storagemart")
    assert st[names[2]][0] == st[names[3]][0] == st[names[4]][0] == "no_match"


def test_latest_as_of_and_ties(spark):
    names = ["cubesmart_weekly_20250127_181344.parquet", "cubesmart_weekly_20250203_181358.parquet",
             "cubesmart_weekly_20250210_061336.parquet", "storagemart_weekly_20250203_090000.parquet",
             "storagemart_weekly_20250203_100000.parquet"]
    cat = _catalog(spark, names)
    got = {r["retailer"]: r["file_name"] for r in C.latest_as_of(cat, "2025-02-05").collect()}
    assert got == {"cubesmart": names[1], "storagemart": names[4]}
    assert C.latest_as_of(cat, "2025-01-01").count() == 0
    order = [r["file_name"] for r in C.newest_first(cat).collect()]
    assert order == [names[2], names[1], names[0], names[4], names[3]]


def test_rule_file_roundtrip(spark):
    path = tempfile.mkdtemp(prefix="rules-", dir="/tmp") + "/rules.json"
    with open(path, "w") as fh:
        json.dump(DEFAULT_RULE_CONFIG, fh, indent=2)
    rows = read_rules_json(spark, path).orderBy("position").collect()
    rules = default_rules()
    assert [r["column"] for r in rows] == [r.column for r in rules]
    assert rows[9]["min_value"] == 4.0 and rows[10]["max_value"] == 9644.4
    from shelfgate.operators.rules import load_rules_spark

    via_spark = load_rules_spark(spark, path)
    assert via_spark == rules          # same rules as the Python reader (kwargs not compared)


def test_type_families():
    assert types_compatible("double", "float") and types_compatible("float", "double")
    assert types_compatible("timestamp_ntz", "timestamp")
    assert types_compatible("timestamp", "date") and not types_compatible("date", "timestamp")
    assert not types_compatible("string", "float") and types_compatible("bigint", "int")


def _schemas(spark):
    rows = []
    base = [("Run_Date", "timestamp"), ("Retailer", "string"), ("Store_Info", "string"),
            ("Category_Traversal", "string"), ("Brand", "string"), ("Product_Name", "string"),
            ("Product_ID", "string"), ("Variant_Info", "string"), ("Size_Or_Quantity", "string"),
            ("Original_Price", "double"), ("In_Stock", "boolean")]
    for f, cols in {
        "a.parquet": base,
        "b.parquet": base,
        "c.parquet": [c for c in base if c[0] != "Brand"] + [("Promo", "string")],
        "d.parquet": [(n, "string" if n == "Original_Price" else t) for n, t in base],
    }.items():
        rows += [(f, i + 1, n, t) for i, (n, t) in enumerate(cols)]
    return spark.createDataFrame(rows, "file_name string, ordinal int, column string, type string")


def test_schema_checks(spark):
    sc = _schemas(spark)
    assert [(r[0], r[1]) for r in S.schema_missing(sc).collect()] == [("c.parquet", "Brand")]
    assert [(r[0], r[1]) for r in S.schema_extra(sc).collect()] == [("c.parquet", "Promo")]
    tm = S.type_mismatch(sc).collect()
    assert [(r["file_name"], r["column"], r["expected_type"], r["actual_type"]) for r in tm] == [
        ("d.parquet", "Original_Price", "float", "string")]
    groups = sorted((r["n_files"], r["first_file"]) for r in S.schema_groups(sc).collect())
    assert groups == [(1, "c.parquet"), (1, "d.parquet"), (2, "a.parquet")]


def test_catalog_helpers(spark):
    import datetime as dt

    from shelfgate.operators.rules import rules_frame

    names = ["cubesmart_weekly_20250127_181344.parquet", "storagemart_weekly_20251399_101010.parquet",
             "x.csv"]
    counts = {r["status"]: r["files"] for r in C.catalog_status_counts(_catalog(spark, names)).collect()}
    assert counts == {"ok": 1, "bad_date": 1, "no_match": 1}
    assert C.default_reference_date(dt.date(2025, 2, 11)) == dt.date(2025, 2, 10)
    rf = rules_frame(spark, default_rules()).orderBy("position").collect()
    assert [r["kind"] for r in rf].count("not_null") == 9 and rf[6]["rule_id"] == "unique:Product_ID"


def test_with_source_file(spark):
    from shelfgate.operators.conform import with_source_file

    path = tempfile.mkdtemp(prefix="src-", dir="/tmp") + "/cubesmart_weekly_20250127_181344.parquet"
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(path)
    names = {r["Source_File"] for r in with_source_file(spark.read.parquet(path)).collect()}
    assert len(names) == 1 and next(iter(names)).startswith("part-")
