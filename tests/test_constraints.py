"""Written constraints: missing rate, JSON validity, uniqueness per group."""

from __future__ import annotations

from shelfgate.operators import constraints as K


def _frame(spark):
    rows = [("r1", "a", '{"x": 1}'), ("r1", "a", "{bad"), ("r1", "b", None), ("r2", "a", '{"y": 2}'),
            ("r2", None, '{"z": 3}'), ("r2", None, "[1, 2]")]
    return spark.createDataFrame(rows, "Retailer string, Product_ID string, Variant_Info string")


def test_missing_and_json_rates(spark):
    df = _frame(spark)
    miss = {r["column"]: (r["missing_rate"], r["passed"])
            for r in K.missing_rates(df, {"Product_ID": 0.5, "Variant_Info": 0.1}).collect()}
    assert miss == {"Product_ID": (2 / 6, True), "Variant_Info": (1 / 6, False)}
    js = K.json_rates(df, {"Variant_Info": 0.95}).collect()[0]
    assert js["valid_rate"] == 4 / 5 and js["passed"] is False       # over non-null values


def test_unique_per_group(spark):
    expected = {("r1", 3, 2, 1, False), ("r2", 1, 1, 0, True)}
    assert {tuple(r) for r in K.unique_per_group(_frame(spark), ["Retailer"], "Product_ID").collect()} == expected


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, "x"), (None, "x"), ("r", "x")], "Retailer string, Product_ID string")
    found = {tuple(r) for r in K.unique_per_group(df, ["Retailer"], "Product_ID").collect()}
    assert found == {(None, 2, 1, 1, False), ("r", 1, 1, 0, True)}
