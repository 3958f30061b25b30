"""Hand-made listing frames, one per corner case (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt

from shelfgate.functions.schema import CANONICAL

T0 = dt.datetime(2025, 1, 27)

RAW_TEXT = ("Run_Date timestamp, Retailer string, Retailer_Website string, Store_Info string, "
            "Category_Traversal string, Brand string, Product_Name string, Product_ID string, "
            "Universal_Product_ID string, Variant_Info string, Size_Or_Quantity string, "
            "Number_Of_Reviews double, Average_Rating string, Original_Price string, Sale_Price string, "
            "Currency string, Url string, In_Stock boolean")
RAW_NUM = RAW_TEXT.replace("Average_Rating string, Original_Price string, Sale_Price string",
                           "Average_Rating double, Original_Price double, Sale_Price double")


_DEFAULT = object()


def row(i, *, pid=_DEFAULT, op=10.0, sp=10.0, cat="Units", brand="B", when=T0, stock=True, text=False,
        store='{"store_id": 1}', variant='{"size": "5x5"}'):
    fmt = (lambda v: None if v is None else str(v)) if text else (lambda v: v)
    return (when, "shop", "https://shop.example", store, cat, brand, f"unit {i}",
            str(i) if pid is _DEFAULT else pid, None, variant, "5x5", None,
            fmt(None), fmt(op), fmt(sp), "USD", f"https://shop.example/{i}", stock)


def frame(spark, rows, schema=RAW_NUM):
    return spark.createDataFrame(rows, schema)


def canonical_names():
    return CANONICAL.fieldNames()
