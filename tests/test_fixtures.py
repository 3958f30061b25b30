"""The derived listing view reproduces the figures of FIXTURES.md section 2 (sf0.01)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from shelfgate.operators.gate import gate
from shelfgate.operators.rules import default_rules
from shelfgate.sources.fixtures import listing

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_listing_view_figures(spark):
    df = listing(spark, SF)
    price = F.trim("Original_Price").try_cast("double")
    r = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("Retailer_Website").alias("websites"),
        F.count("Category_Traversal").alias("categories"),
        F.count("Product_ID").alias("ids"),
        F.countDistinct("Product_ID").alias("distinct_ids"),
        F.count("Original_Price").alias("prices"),
        F.count(price).alias("numeric_prices"),
        F.count("Sale_Price").alias("sale_prices"),
        F.count("Universal_Product_ID").alias("universal"),
        F.count_if(F.col("Variant_Info") == "{bad").alias("bad_json"),
        F.min("Run_Date").cast("date").cast("string").alias("first_week"),
        F.max("Run_Date").cast("date").cast("string").alias("last_week"),
    ).first().asDict()
    assert r == {"rows": 10000, "websites": 9016, "categories": 9900, "ids": 9952, "distinct_ids": 9754,
                 "prices": 8750, "numeric_prices": 8416, "sale_prices": 10000, "universal": 2000,
                 "bad_json": 250, "first_week": "2024-01-01", "last_week": "2024-01-29"}
    assert gate(df, default_rules()).quarantine().count() == 598
