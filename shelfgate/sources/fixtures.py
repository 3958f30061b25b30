"""Listing-shaped views derived from the shared test tables.

The engine's input is weekly listing files; the test tables are a TPC-H-like
star schema plus an ``events`` table. These views derive listing rows, file
names and per-file schemas from ``events`` with fixed, engine-portable
expressions, so the same rows can be rebuilt in any SQL engine for checks.
Their size grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import CANONICAL, SOURCE_FILE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing rows: the 18 canonical names, text prices (the "group 1" shape)."""
    ev = table(spark, sf_dir, "events")
    eid, uid, et, val = F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("value")
    return ev.select(
        # wall-clock week start, like a pandas-written file (no time zone); the
        # conformed table casts it to the canonical timestamp
        F.date_trunc("week", F.col("ts")).cast("timestamp_ntz").alias("Run_Date"),
        et.alias("Retailer"),
        F.when(uid % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://"), et, F.lit(".example"))).alias("Retailer_Website"),
        F.concat(F.lit('{"store_id": '), _s(uid), F.lit("}")).alias("Store_Info"),
        F.when(eid % 101 == 0, F.lit(None).cast("string")).otherwise(et).alias("Category_Traversal"),
        et.alias("Brand"),
        F.concat(F.lit("unit "), _s(eid)).alias("Product_Name"),
        F.when(eid % 211 == 0, F.lit(None).cast("string"))
         .when(eid % 50 == 1, _s(eid - 1)).otherwise(_s(eid)).alias("Product_ID"),
        F.when(eid % 5 == 0, F.lit("")).otherwise(F.lit(None).cast("string")).alias("Universal_Product_ID"),
        F.when(eid % 40 == 0, F.lit("{bad")).otherwise(F.col("props")).alias("Variant_Info"),
        _s(uid % 7).alias("Size_Or_Quantity"),
        F.lit(None).cast("string").alias("Number_Of_Reviews"),
        F.lit(None).cast("string").alias("Average_Rating"),
        F.when(eid % 8 == 0, F.lit(None).cast("string"))
         .when(eid % 30 == 7, F.concat(F.lit("$"), _s(val)))
         .otherwise(_s(val * 20)).alias("Original_Price"),
        _s(val * 12).alias("Sale_Price"),
        F.lit("USD").alias("Currency"),
        F.concat(F.lit("https://"), et, F.lit(".example/"), _s(eid)).alias("Url"),
        (et != F.lit("error")).alias("In_Stock"),
    )


def source_file_name(retailer: Column, run_date: Column) -> Column:
    """One file per retailer and week: ``<retailer>_weekly_<yyyyMMdd>_000000.parquet``."""
    return F.concat(retailer, F.lit("_weekly_"), F.date_format(run_date, "yyyyMMdd"),
                    F.lit("_000000.parquet"))


def listing_with_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = listing(spark, sf_dir)
    return df.withColumn(SOURCE_FILE, source_file_name(F.col("Retailer"), F.col("Run_Date")))


# --- fixed values: names that must not enter the catalog, one per negative case
NEGATIVE_FILE_NAMES = [
    "unknownshop_weekly_20240105_101010.parquet",    # unknown source
    "click_weekly_20240105.parquet",                  # missing time
    "click_weekly_20240105_101010.csv",               # wrong ending
    "view_weekly_20251399_101010.parquet",            # impossible date
    "signup_weekly_20240120_080000.parquet",          # two times on one day
    "signup_weekly_20240120_235959.parquet",
]
EVENT_SOURCES = ["click", "error", "purchase", "signup", "view"]
LANDING_DIR = "/landing"


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing file path per ``events`` row, plus the negative cases."""
    ev = table(spark, sf_dir, "events")
    name = F.concat(F.col("event_type"), F.lit("_weekly_"), F.date_format("ts", "yyyyMMdd"),
                    F.lit("_"), F.date_format("ts", "HHmmss"), F.lit(".parquet"))
    derived = ev.select(F.concat(F.lit(LANDING_DIR + "/"), name).alias("path"))
    extra = spark.createDataFrame([(f"{LANDING_DIR}/{n}",) for n in NEGATIVE_FILE_NAMES], "path string")
    return derived.unionByName(extra)


def file_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-file schema rows ``(file_name, ordinal, column, type)`` with drift.

    One file per ``events`` row. Prices are text for click/view files and
    double otherwise; by ``event_id``: %97 no Brand, %89 no Currency, %83 an
    extra ``Promo_Code`` after Url, %79 In_Stock as text, %73 Run_Date as date.
    """
    ev = table(spark, sf_dir, "events")
    eid, et = F.col("event_id"), F.col("event_type")
    fname = F.concat(et, F.lit("_weekly_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"),
                     F.date_format("ts", "HHmmss"), F.lit("_"), _s(eid), F.lit(".parquet"))
    text_prices = et.isin("click", "view")
    price_t = F.when(text_prices, F.lit("string")).otherwise(F.lit("double"))
    entries = []
    droppable = {}                      # position -> condition (on event id) that the column is absent
    e = F.col("_eid")
    for f in CANONICAL.fields:
        t = F.lit(f.dataType.simpleString())
        present = F.lit(True)
        if f.name in ("Average_Rating", "Original_Price", "Sale_Price"):
            t = price_t
        elif f.name == "Number_Of_Reviews":
            t = F.lit("double")
        elif f.name == "In_Stock":
            t = F.when(eid % 79 == 0, F.lit("string")).otherwise(F.lit("boolean"))
        elif f.name == "Run_Date":
            t = F.when(eid % 73 == 0, F.lit("date")).otherwise(F.lit("timestamp"))
        if f.name == "Brand":
            present = eid % 97 != 0
            droppable[len(entries)] = e % 97 == 0
        elif f.name == "Currency":
            present = eid % 89 != 0
            droppable[len(entries)] = e % 89 == 0
        entries.append(F.struct(F.lit(f.name).alias("column"), t.alias("type"), present.alias("present")))
        if f.name == "Url":
            droppable[len(entries)] = e % 83 != 0
            entries.append(F.struct(F.lit("Promo_Code").alias("column"), F.lit("string").alias("type"),
                                    (eid % 83 == 0).alias("present")))
    exploded = ev.select(fname.alias("file_name"), eid.alias("_eid"),
                         F.posexplode(F.array(*entries)).alias("pos", "c"))
    # ordinal among present columns: position minus the absent columns before it
    skipped = sum([F.when((F.lit(i) < F.col("pos")) & cond, 1).otherwise(0) for i, cond in droppable.items()],
                  F.lit(0))
    return (exploded.where(F.col("c.present"))
            .select("file_name", (F.col("pos") + 1 - skipped).cast("int").alias("ordinal"),
                    F.col("c.column").alias("column"), F.col("c.type").alias("type")))
