"""Exploration of a folder: groups by schema, normalized union, profile; bad files reported."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from shelfgate.plans.explore import explore, profile_report

from frames import RAW_TEXT, frame, row


def test_explore_folder(spark):
    root = tempfile.mkdtemp(prefix="explore-", dir="/tmp") + "/in"
    os.makedirs(root)
    frame(spark, [row(1), row(2)]).coalesce(1).write.parquet(f"{root}/cubesmart_weekly_20250127_181344.parquet")
    frame(spark, [row(3)]).coalesce(1).write.parquet(f"{root}/cubesmart_weekly_20250203_181358.parquet")
    frame(spark, [row(4, text=True, op="7.5")], RAW_TEXT).coalesce(1).write.parquet(
        f"{root}/storagemart_weekly_20250127_090843.parquet")
    with open(f"{root}/smartstopselfstorage_weekly_20250127_090106.parquet", "w") as fh:
        fh.write("this is not parquet")
    res = explore(spark, root)
    groups = sorted((r["n_files"], r["first_file"]) for r in res.groups.collect())
    assert groups == [(1, "storagemart_weekly_20250127_090843.parquet"),
                      (2, "cubesmart_weekly_20250127_181344.parquet")]
    assert [r["file_name"] for r in res.unreadable.collect()] == [
        "smartstopselfstorage_weekly_20250127_090106.parquet"]
    u = res.unified
    assert u.columns[-1] == "Source_File" and len(u.columns) == 19
    assert dict(u.dtypes)["Original_Price"] == "double"
    assert u.where(F.col("Source_File").startswith("storagemart")).first()["Original_Price"] == 7.5
    rep = profile_report(u)
    assert rep["dataset"].first()["rows"] == 4
    kinds = {r["column"]: r["kind"] for r in rep["kinds"].collect()}
    assert kinds["Number_Of_Reviews"] == "Unsupported" and kinds["In_Stock"] == "Boolean"


def test_explore_named_files(spark):
    root = tempfile.mkdtemp(prefix="explore-named-", dir="/tmp") + "/in"
    os.makedirs(root)
    names = ["cubesmart_weekly_20250127_181344.parquet", "cubesmart_weekly_20250203_181358.parquet"]
    for i, n in enumerate(names):
        frame(spark, [row(i)]).coalesce(1).write.parquet(f"{root}/{n}")
    res = explore(spark, root, files=names[1:])
    assert [r["Source_File"] for r in res.unified.collect()] == names[1:]


def test_footer_fallback_through_spark(spark):
    """A footer the executors could not open is read again by Spark; a broken file stays unreadable."""
    from shelfgate.sources.catalog import entry_files
    from shelfgate.sources.listing import UNREADABLE, with_spark_fallback

    root = tempfile.mkdtemp(prefix="fallback-", dir="/tmp")
    good = f"{root}/good.parquet"
    spark.createDataFrame([(1, "a")], "x bigint, y string").coalesce(1).write.parquet(good)
    with open(f"{root}/bad.parquet", "w") as fh:
        fh.write("broken")
    mixed = f"{root}/mixed.parquet"   # parts that Spark does not merge are asked one by one
    spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(mixed)
    spark.createDataFrame([("a",)], "x string").coalesce(1).write.mode("append").parquet(mixed)
    names = ["bad.parquet", "good.parquet", "mixed.parquet"]
    files = entry_files(spark, root, spark.createDataFrame([(f"file:{root}/{n}", n) for n in names],
                                                           "path string, file_name string"))
    parts = files.select("file_name", "leaf", F.lit(None).cast("string").alias("digest"), F.lit(0).alias("ordinal"),
                         F.lit(UNREADABLE).alias("column"), F.lit("OSError: no such file system").alias("type"))
    parts = parts.unionByName(spark.createDataFrame([("other.parquet", "o", "d", 1, "z", "int")], parts.schema))
    out = sorted((r["file_name"], r["ordinal"], r["column"], r["type"])
                 for r in with_spark_fallback(spark, parts, files).collect())
    assert out == [("bad.parquet", 0, UNREADABLE, "OSError: no such file system"),
                   ("good.parquet", 1, "x", "bigint"), ("good.parquet", 2, "y", "string"),
                   ("mixed.parquet", 1, "x", "int"), ("mixed.parquet", 1, "x", "string"),
                   ("other.parquet", 1, "z", "int")]
