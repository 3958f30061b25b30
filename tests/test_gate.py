"""Gate corner cases: null, NaN, uniqueness with nulls, bounds, text prices, verdicts."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from shelfgate.functions.schema import CANONICAL, required_names
from shelfgate.operators.conform import conform_types
from shelfgate.operators.gate import gate
from shelfgate.operators.rules import default_rules, parse_rules

from frames import RAW_TEXT, frame, row

RULES = default_rules()


def _failed(g):
    return {r["Product_Name"]: list(r["failed_rules"]) for r in g.flagged().collect()}


def _verdict(g):
    return {r["file"]: r["outcome"] for r in g.verdicts().collect()}


def test_clean_numeric_accepts(spark):
    df = frame(spark, [row(i) for i in range(5)])
    g = gate(df, RULES, required=required_names())
    assert all(v == [] for v in _failed(g).values())
    assert _verdict(g) == {"<all>": "accept"}
    assert g.survivors().count() == 5


def test_text_prices_cast_and_error_modes(spark):
    rows = [row(1, op="120", text=True), row(2, op="$12.00", text=True), row(3, op=None, text=True)]
    df = frame(spark, rows, RAW_TEXT)
    g = gate(df, RULES, on_type_error="cast")
    assert _verdict(g) == {"<all>": "accept"}          # "$12.00" is not a number: never out of range
    out = conform_types(g.survivors()).orderBy("Product_Name").collect()
    assert [r["Original_Price"] for r in out] == [120.0, None, None]
    g2 = gate(df, RULES, on_type_error="error")
    # range rules error out, no row fails: the whole file is rejected
    assert _verdict(g2) == {"<all>": "reject"}
    assert g2.survivors().count() == 0
    statuses = {r["rule_id"]: r["status"] for r in g2.rule_report().collect()}
    assert statuses["between:Original_Price"] == "error"


def test_error_rule_with_failing_rows_repairs(spark):
    rows = [row(1, op="120", text=True), row(2, op="130", cat=None, text=True)]
    g = gate(frame(spark, rows, RAW_TEXT), RULES, on_type_error="error")
    assert _verdict(g) == {"<all>": "repair"}
    assert [r["Product_Name"] for r in g.survivors().collect()] == ["unit 1"]


def test_null_required_empty_string_passes(spark):
    rows = [row(1, cat=None), row(2, brand=""), row(3)]
    g = gate(frame(spark, rows), RULES)
    f = _failed(g)
    assert f["unit 1"] == ["not_null:Category_Traversal"]
    assert f["unit 2"] == [] and f["unit 3"] == []
    assert _verdict(g) == {"<all>": "repair"}


def test_nan_prices(spark):
    rows = [row(1, op=float("nan")), row(2, op=None), row(3, op=99999.0)]
    g = gate(frame(spark, rows), RULES)
    f = _failed(g)
    assert f["unit 1"] == [] and f["unit 2"] == []            # NaN and null never out of range
    assert f["unit 3"] == ["between:Original_Price"]
    # not-null on a double column treats NaN as missing
    nn = parse_rules({"expectations": [{"expectation_type": "ExpectColumnValuesToNotBeNull",
                                        "kwargs": {"column": "Original_Price"}}]})
    f2 = _failed(gate(frame(spark, rows), nn))
    assert f2["unit 1"] == ["not_null:Original_Price"] and f2["unit 2"] == ["not_null:Original_Price"]


def test_dup_ids_all_copies_fail(spark):
    rows = [row(1, pid="A"), row(2, pid="A"), row(3, pid="B")]
    f = _failed(gate(frame(spark, rows), RULES))
    assert f["unit 1"] == ["unique:Product_ID"] and f["unit 2"] == ["unique:Product_ID"]
    assert f["unit 3"] == []


def test_dup_and_null_ids_nulls_fail(spark):
    rows = [row(1, pid="A"), row(2, pid="A"), row(3, pid=None), row(4, pid=None), row(5, pid="C")]
    f = _failed(gate(frame(spark, rows), RULES))
    assert f["unit 3"] == ["unique:Product_ID"] and f["unit 4"] == ["unique:Product_ID"]
    assert f["unit 5"] == []


def test_only_null_ids_pass(spark):
    rows = [row(1, pid=None), row(2, pid=None), row(3, pid="C")]
    f = _failed(gate(frame(spark, rows), RULES))
    assert all(v == [] for v in f.values())


def test_uniqueness_is_per_file(spark):
    rows = [row(1, pid="A"), row(2, pid="A")]
    df = frame(spark, rows).withColumn("file", F.concat(F.lit("f"), F.col("Product_Name")))
    f = _failed(gate(df, RULES, file_col="file"))
    assert all(v == [] for v in f.values())


def test_bounds_inclusive_double_before_float(spark):
    rows = [row(1, op=4.0, sp=2.4), row(2, op=5760.0, sp=9644.4),
            row(3, op=3.999, sp=2.39), row(4, op=5760.01, sp=9644.41)]
    f = _failed(gate(frame(spark, rows), RULES))
    assert f["unit 1"] == [] and f["unit 2"] == []
    assert f["unit 3"] == ["between:Original_Price", "between:Sale_Price"]
    assert f["unit 4"] == ["between:Original_Price", "between:Sale_Price"]


def test_all_fail_rejects(spark):
    rows = [row(1, cat=None), row(2, cat=None)]
    g = gate(frame(spark, rows), RULES)
    v = g.verdicts().collect()[0]
    assert v["outcome"] == "reject" and v["survivors"] == 0


def test_missing_required_rejects(spark):
    df = frame(spark, [row(1)]).drop("Brand")
    g = gate(df, RULES, required=required_names())
    assert _verdict(g) == {"<all>": "reject"}
    assert g.survivors().count() == 0


def test_missing_optional_filled(spark):
    df = frame(spark, [row(1)]).drop("Currency")
    g = gate(df, RULES, required=required_names())
    assert _verdict(g) == {"<all>": "accept"}
    out = conform_types(g.survivors(), fill_missing=True)
    assert out.columns == CANONICAL.fieldNames()
    assert out.collect()[0]["Currency"] is None


def test_unknown_and_absent_rules_skipped(spark):
    rules = parse_rules({"expectations": [
        {"expectation_type": "ExpectSomethingElse", "kwargs": {"column": "Brand"}},
        {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Nope"}},
        {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {}},
    ]})
    g = gate(frame(spark, [row(1)]), rules)
    st = [r["status"] for r in g.rule_report().orderBy("position").collect()]
    assert st == ["skipped", "skipped", "error"]
    assert _verdict(g) == {"<all>": "reject"}   # a rule error with no failing row rejects


def test_mostly_tolerance(spark):
    rules = parse_rules({"expectations": [{"expectation_type": "ExpectColumnValuesToNotBeNull",
                                           "kwargs": {"column": "Category_Traversal", "mostly": 0.5}}]})
    rows = [row(1, cat=None), row(2), row(3)]
    g = gate(frame(spark, rows), rules)
    assert all(v == [] for v in _failed(g).values())    # 1/3 missing <= 0.5: rule passes, nothing drops
    rows = [row(1, cat=None), row(2, cat=None), row(3)]
    g = gate(frame(spark, rows), rules)
    assert sorted(k for k, v in _failed(g).items() if v) == ["unit 1", "unit 2"]


def test_survivors_plus_quarantine_is_input(spark):
    rows = [row(i, pid=str(i % 7), op=float(i)) for i in range(60)]
    g = gate(frame(spark, rows), RULES)
    assert g.survivors().count() + g.quarantine().count() == 60


def test_gate_independent_of_partitioning(spark):
    rows = [row(i, pid=str(i % 11), op=float(i * 37 % 7000), cat=None if i % 13 == 0 else "c")
            for i in range(300)]
    a = frame(spark, rows)
    b = a.repartition(7)
    fa = sorted((k, tuple(v)) for k, v in _failed(gate(a, RULES)).items())
    fb = sorted((k, tuple(v)) for k, v in _failed(gate(b, RULES)).items())
    assert fa == fb


def test_hot_key_path_matches_plain_count(spark, monkeypatch):
    """Force the hot-key path (tiny threshold) and compare with a plain window count."""
    from pyspark.sql import Window

    from shelfgate.operators import keys

    rows = [(i, "HOT" if i % 3 == 0 else (None if i % 17 == 0 else f"k{i % 40}")) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, k string")
    monkeypatch.setattr(keys, "HOT_ROWS_FLOOR", 10)
    monkeypatch.setattr(keys, "MAX_BROADCAST_BYTES", -1)
    got = keys.with_key_count(df, ["k"], "n").select("id", "n")
    ref = df.withColumn("n", F.when(F.col("k").isNotNull(), F.count(F.lit(1)).over(Window.partitionBy("k"))))
    assert sorted(got.collect()) == sorted(ref.select("id", "n").collect())
    got2 = keys.with_key_count(df, ["k"], "n", nulls_equal=True).select("id", "n")
    ref2 = df.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")))
    assert sorted(got2.collect()) == sorted(ref2.select("id", "n").collect())


def test_text_bool_and_bad_date_cast(spark):
    df = spark.createDataFrame([("2025-01-27 10:00:00", "True"), ("not a date", "False"), (None, "x")],
                               "Run_Date string, In_Stock string")
    out = conform_types(df).collect()
    assert out[0]["In_Stock"] is True and out[1]["In_Stock"] is False and out[2]["In_Stock"] is None
    assert out[0]["Run_Date"] is not None and out[1]["Run_Date"] is None


def test_float_rounding_of_prices(spark):
    df = frame(spark, [row(1, op=9644.4, sp=2.4)])
    out = conform_types(df).collect()[0]
    assert math.isclose(out["Original_Price"], 9644.4, rel_tol=1e-6)
    assert dict(conform_types(df).dtypes)["Original_Price"] == "float"


def test_gate_beyond_the_broadcast_matches(spark, monkeypatch):
    """Beyond the broadcast bound the bit map and the salted join give the same flags."""
    from shelfgate.operators import keys

    rows = [row(i, pid=str(i % 9) if i % 5 else None, cat=None if i % 23 == 0 else "c") for i in range(200)]
    df = frame(spark, rows).withColumn("file", F.when(F.col("Product_Name") < "unit 5", "f1").otherwise("f2"))
    a = sorted((k, tuple(v)) for k, v in _failed(gate(df, RULES, file_col="file")).items())
    monkeypatch.setattr(keys, "MAX_BROADCAST_BYTES", -1)
    monkeypatch.setattr(keys, "FILTER_BITS", 64)
    monkeypatch.setattr(keys, "HOT_ROWS_FLOOR", 5)
    b = sorted((k, tuple(v)) for k, v in _failed(gate(df, RULES, file_col="file")).items())
    assert a == b


def test_empty_input(spark):
    from shelfgate.operators import audit as A
    from shelfgate.operators import profile as P

    df = frame(spark, []).withColumn("file", F.lit("f"))
    g = gate(df, RULES, required=required_names())
    assert g.survivors().count() == 0 and g.quarantine().count() == 0 and g.verdicts().count() == 0
    g2 = gate(df, RULES, file_col="file")
    assert g2.rule_report().count() == 0
    rep = A.report_dict(A.audit(df.drop("file")))
    assert rep["duplicate_check"]["details"]["total_records"] == 0 and rep["overall_passed"] is True
    s = P.dataset_summary(df.drop("file")).first()
    assert s["rows"] == 0 and s["duplicate_rows"] == 0


def test_reordered_columns_conform_by_name(spark):
    df = frame(spark, [row(1), row(2)])
    shuffled = df.select(*reversed(df.columns))
    g = gate(shuffled, RULES, required=required_names())
    out = conform_types(g.survivors(), fill_missing=True)
    assert out.columns == CANONICAL.fieldNames()
    assert sorted(r["Product_Name"] for r in out.collect()) == ["unit 1", "unit 2"]


def test_bad_date_text_passes_gate_then_audit_finds_it(spark):
    from shelfgate.operators import audit as A

    rows = [row(1), row(2)]
    df = frame(spark, rows).withColumn(
        "Run_Date", F.when(F.col("Product_Name") == "unit 1", "2025-01-27 00:00:00").otherwise("27/01/2025?"))
    g = gate(df, RULES, required=required_names())
    assert _verdict(g) == {"<all>": "accept"}                 # non-null text passes the not-null rule
    table = conform_types(g.survivors(), fill_missing=True)
    rep = A.report_dict(A.audit(table))
    assert rep["null_check"]["details"]["null_counts"] == {"Run_Date": 1}
    assert rep["overall_passed"] is False


def test_every_row_is_survivor_or_quarantined(spark):
    """Rows of rejected files (rule error, no failing row) and of a null file key are kept track of."""
    rules = parse_rules({"expectations": [
        {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {}},
        {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Category_Traversal"}}]})
    rows = [row(1), row(2, cat=None), row(3), row(4)]
    df = frame(spark, rows).withColumn(
        "file", F.when(F.col("Product_Name") == "unit 4", F.lit(None)).when(
            F.col("Product_Name") == "unit 3", "b").otherwise("a"))
    g = gate(df, rules, file_col="file")
    v = {r["file"]: r["outcome"] for r in g.verdicts().collect()}
    assert v == {"a": "repair", "b": "reject", "<no file>": "reject"}
    assert g.survivors().count() + g.quarantine().count() == 4
    assert sorted(r["Product_Name"] for r in g.quarantine().collect()) == ["unit 2", "unit 3", "unit 4"]
