"""Audit and profile on small frames with known answers."""

from __future__ import annotations

import math

from shelfgate.operators import audit as A
from shelfgate.operators import profile as P


def _keys_frame(spark):
    rows = [("r", "s", "1", 1), ("r", "s", "1", 1), ("r", "s", None, 1), ("r", "s", None, 1),
            ("r", "t", "2", 1), ("r", "t", "3", 2)]
    return spark.createDataFrame(rows, "Retailer string, Store_Info string, Product_ID string, Run_Date int")


def test_duplicate_summary_nulls_equal(spark):
    r = A.duplicate_summary(_keys_frame(spark)).collect()[0]
    assert (r["total_records"], r["unique_records"], r["duplicate_records"], r["passed"]) == (6, 4, 2, False)


def test_duplicate_rows_and_sample(spark):
    df = _keys_frame(spark)
    rows = A.duplicate_rows(df, limit=10).collect()
    assert len(rows) == 4 and all(r["dup_count"] == 2 for r in rows)
    # nulls first, like Spark's ascending order
    assert rows[0]["Product_ID"] is None
    sample = A.duplicate_sample(df, limit=5).collect()
    assert [(r["Product_ID"], r["dup_count"]) for r in sample] == [(None, 2), ("1", 2)]


def test_dedupe_keeps_smallest(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (2, "z", 1.0)], "k int, x string, y double")
    got = sorted(tuple(r) for r in A.dedupe_by_key(df, ["k"]).collect())
    assert got == [(1, "a", 9.0), (2, "z", 1.0)]


def test_audit_report_fields(spark):
    df = _keys_frame(spark).withColumnRenamed("Run_Date", "Extra")
    rep = A.report_dict(A.audit(df, keys=["Retailer", "Store_Info", "Product_ID", "Run_Date"]))
    assert rep["schema_validation"]["passed"] is False
    assert "Run_Date" in rep["schema_validation"]["details"]["missing_columns"]
    assert rep["schema_validation"]["details"]["extra_columns"] == ["Extra"]
    assert rep["null_check"]["details"]["null_counts"] == {"Product_ID": 2}
    assert rep["overall_passed"] is False


def test_profile_small(spark):
    rows = [(1.0, 2.0, "a", "USD", None, True), (2.0, 4.0, "b", "USD", None, False),
            (3.0, 6.1, "a", "USD", None, True), (None, 1.0, "c", None, None, True)]
    df = spark.createDataFrame(rows, "x double, y double, cat string, cur string, empty string, ok boolean")
    miss = {r["column"]: r["n_missing"] for r in P.missing(df).collect()}
    assert miss == {"x": 1, "y": 0, "cat": 0, "cur": 1, "empty": 4, "ok": 0}
    assert {r["column"] for r in P.constant_columns(df).collect()} == {"cur"}
    kinds = {r["column"]: r["kind"] for r in P.kinds(df).collect()}
    assert kinds == {"x": "Numeric", "y": "Numeric", "cat": "Categorical", "cur": "Categorical",
                     "empty": "Unsupported", "ok": "Boolean"}
    corr = P.numeric_correlation(df, ["x", "y"]).collect()[0]["corr"]
    assert math.isclose(corr, 0.999901, abs_tol=1e-6)
    summary = P.dataset_summary(df).collect()[0]
    assert summary["rows"] == 4 and summary["missing_cells"] == 6 and summary["duplicate_rows"] == 0


def test_duplicate_row_count_exact(spark):
    rows = [(1, None), (None, 1), (1, None), (2, 2), (2, 2), (2, 2)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert P.duplicate_row_count(df) == 3


def test_cramers_v_perfect_and_independent(spark):
    rows = [("a", "x")] * 10 + [("b", "y")] * 10
    df = spark.createDataFrame(rows, "p string, q string")
    v = P.categorical_association(df, ["p", "q"]).collect()[0]["cramers_v"]
    assert math.isclose(v, 1.0)
    rows = [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")] * 5
    v = P.categorical_association(spark.createDataFrame(rows, "p string, q string"), ["p", "q"]).collect()[0]
    assert math.isclose(v["cramers_v"], 0.0, abs_tol=1e-9)


def test_audit_without_keys_and_missing_table(spark):
    from shelfgate.plans.audit import run_audit

    df = spark.createDataFrame([(1,), (1,)], "Brand int")
    rep = A.report_dict(A.audit(df))
    assert rep["duplicate_check"]["passed"] is False
    assert rep["duplicate_check"]["details"]["error"] == "Missing key columns for duplicate check"
    assert rep["data_type_validation"]["details"]["type_mismatches"] == [
        {"column": "Brand", "expected_type": "string", "actual_type": "int"}]
    missing = A.report_dict(run_audit(spark, "/tmp/no-such-table-here", checked_at="2025-01-01 00:00:00"))
    assert "overall_passed" not in missing and missing["schema_validation"]["passed"] is False


def test_distinct_counts_exact_and_approx(spark):
    df = spark.createDataFrame([(str(i % 7), None) for i in range(100)], "a string, b string")
    exact = {r["column"]: r["n_distinct"] for r in P.distinct_counts(df).collect()}
    assert exact == {"a": 7, "b": 0}
    approx = {r["column"]: r["n_distinct"] for r in P.distinct_counts(df, approx_rsd=0.01).collect()}
    assert approx == {"a": 7, "b": 0}


def test_scale_conf():
    from shelfgate.session import scale_conf

    conf = scale_conf(100 << 40, executors=1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_duplicates_and_dedupe_by_rows(spark):
    rows = [(i % 13, f"v{i % 5}", None if i % 7 == 0 else i % 3) for i in range(300)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "k int, s string, x int")
    assert P.duplicate_row_count(df) == len(rows) - len(set(rows))
    first = {}
    for k, s, x in rows:        # nulls first
        first[k, s] = min(first.get((k, s), (9, 9)), (x is not None, x or 0))
    want = sorted((k, s, x if some else None) for (k, s), (some, x) in first.items())
    assert sorted(tuple(r) for r in A.dedupe_by_key(df, ["k", "s"]).collect()) == want


def test_association_takes_columns_of_many_levels(spark):
    rows = [(f"t{i}", f"c{i % 4}", "one", i % 2 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "t string, c string, k string, b boolean")
    cols = P.association_columns(df)
    assert cols == {"t": 400, "c": 4, "b": 2}
    found = {tuple(r) for r in P.categorical_association(df, cols).collect()}
    found = {(a, b, round(v, 6), n) for a, b, v, n in found}
    assert found == {("t", "c", 1.0, 400), ("t", "b", 1.0, 400), ("c", "b", 1.0, 400)}


def test_audit_report_decimal_type_names(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(Decimal("1.50"), "a")], "Original_Price decimal(10,2), Retailer string")
    rep = A.report_dict(A.audit(df, keys=["Retailer"]))
    assert rep["data_type_validation"]["details"]["type_mismatches"] == [
        {"column": "Original_Price", "expected_type": "float", "actual_type": "decimal(10,2)"}]


def test_save_report_logs_instead_of_raising(spark, tmp_path):
    df = _keys_frame(spark)
    rep = A.audit(df, keys=["Retailer"])
    good = str(tmp_path / "report")
    assert A.save_report(rep, good) is True
    assert A.save_report(rep, "/proc/not-writable/report") is False


def test_distinct_counts_do_not_depend_on_size_or_partitions(spark):
    rows = [(f"t{i}", f"c{i % 4}", None, i % 2 == 0) for i in range(400)]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "t string, c string, n string, b boolean").repartition(parts)
        found = {r["column"]: (r["kind"], r["n_distinct"]) for r in P.column_stats(df).collect()}
        assert found == {"t": ("Text", 400), "c": ("Categorical", 4), "n": ("Unsupported", 0), "b": ("Boolean", 2)}
