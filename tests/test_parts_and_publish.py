"""Entries whose parts differ, and publication that survives failures and reruns."""

from __future__ import annotations

import datetime as dt
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfgate.functions.schema import CANONICAL, merged_type
from shelfgate.operators.rules import default_rules
from shelfgate.plans import ingest as I
from shelfgate.plans.explore import explore
from shelfgate.plans.ingest import run_ingest
from shelfgate.sources import publish
from shelfgate.sources.listing import Group, Route
from shelfgate.sources.sinks import read_unified

from frames import RAW_NUM, RAW_TEXT, frame, row

NAME = "cubesmart_weekly_20250127_181344.parquet"
OTHER = "storagemart_weekly_20250127_181344.parquet"


def _parts(root, frames, order, name=NAME):
    """One part file per frame, named so that they sort in the given order."""
    folder = f"{root}/{name}"
    os.makedirs(folder)
    for k, df in zip(order, frames):
        df.toPandas().to_parquet(f"{folder}/part-{k}.parquet", index=False, coerce_timestamps="us",
                                 allow_truncated_timestamps=True)


def _ingest(spark, root, out, **kw):
    return run_ingest(spark, str(root), str(out), default_rules(), reference_date=dt.date(2025, 2, 5), **kw)


@pytest.mark.parametrize("order", [("a", "b"), ("b", "a")])
def test_no_column_is_lost_whatever_the_parts_are_called(spark, tmp_path, order):
    lacking = frame(spark, [row(i) for i in range(3)]).drop("Url", "Brand")
    whole = frame(spark, [row(i) for i in range(3, 6)]).withColumn("Promo", F.lit("p"))
    _parts(tmp_path / "in", [lacking, whole], order)
    res = _ingest(spark, tmp_path / "in", tmp_path / "out", column_log_path=str(tmp_path / "log"), detection_time="2025-02-05 00:00:00")
    # Brand is null in the first part only: its rows fail the rule, the file is no longer rejected for it
    assert [(r["outcome"], r["rows"], r["survivors"]) for r in res.outcome.verdicts.collect()] == [("repair", 6, 3)]
    assert {r["Product_Name"]: r["Url"] for r in read_unified(spark, str(tmp_path / "out")).collect()} == {
        f"unit {i}": f"https://shop.example/{i}" for i in range(3, 6)}
    assert [r["new_column"] for r in spark.read.parquet(str(tmp_path / "log")).collect()] == ["Promo"]
    found = explore(spark, str(tmp_path / "in"))
    assert sorted((r["Product_Name"], r["Url"], r["Source_File"]) for r in found.unified.collect()) == [
        (f"unit {i}", f"https://shop.example/{i}" if i > 2 else None, NAME) for i in range(6)]
    assert found.groups.count() == 1


@pytest.mark.parametrize("order", [("a", "b"), ("b", "a")])
def test_parts_of_incompatible_types_reject_their_file_by_name(spark, tmp_path, order):
    numbers = frame(spark, [row(1, op=10.0)])
    texts = frame(spark, [row(2, text=True, op="20.0")], RAW_TEXT)
    _parts(tmp_path / "in", [numbers, texts], order)
    _parts(tmp_path / "in", [frame(spark, [row(3)]), frame(spark, [row(4)])], order, OTHER)
    res = _ingest(spark, tmp_path / "in", tmp_path / "out")
    verdicts = {r["file"]: (r["outcome"], r["reason"]) for r in res.outcome.verdicts.collect()}
    assert verdicts[OTHER][0] == "accept"
    assert verdicts[NAME][0] == "reject" and verdicts[NAME][1].startswith("incompatible parts: ")
    assert "Original_Price: double, string" in verdicts[NAME][1]
    found = explore(spark, str(tmp_path / "in"))
    assert [r["file_name"] for r in found.unreadable.collect()] == [NAME]
    assert found.unified.count() == 2


def test_widened_columns_keep_their_values(spark, tmp_path):
    narrow = frame(spark, [row(1, op=10.0)]).withColumn("Original_Price", F.lit(2147483647).cast("int"))
    wide = frame(spark, [row(2, op=10.5)])
    day = frame(spark, [row(3, op=11.0)]).withColumn("Run_Date", F.lit(dt.date(2025, 1, 20)))
    _parts(tmp_path / "in", [narrow, wide, day], "abc")
    rows = explore(spark, str(tmp_path / "in")).unified.collect()
    assert {r["Product_Name"]: r["Original_Price"] for r in rows} == {"unit 1": 2147483647.0, "unit 2": 10.5, "unit 3": 11.0}
    assert {r["Product_Name"]: r["Run_Date"].day for r in rows} == {"unit 1": 27, "unit 2": 27, "unit 3": 20}


def test_parts_deeper_down_and_nanoseconds_beside_microseconds(spark, tmp_path):
    folder = tmp_path / "in" / NAME / "deep" / "er"
    folder.mkdir(parents=True)
    for k, stamp in enumerate(["2025-01-27 10:11:12.123456999", "2025-01-27 00:00:00"]):
        pdf = pd.DataFrame([row(k)], columns=[c.split()[0] for c in RAW_NUM.split(", ")])
        pdf["Run_Date"] = pd.to_datetime([stamp])
        if k:
            pdf.to_parquet(tmp_path / "in" / NAME / "z.parquet", index=False, coerce_timestamps="us")
        else:
            pdf.to_parquet(folder / "a.parquet", index=False)
    before = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong")
    res = _ingest(spark, tmp_path / "in", tmp_path / "out")
    assert res.ok, res.reason
    assert sorted(r["Run_Date"] for r in read_unified(spark, str(tmp_path / "out")).collect()) == [
        dt.datetime(2025, 1, 27), dt.datetime(2025, 1, 27, 10, 11, 12, 123456)]
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == before


def test_a_part_with_a_broken_footer_rejects_its_file(spark, tmp_path):
    _parts(tmp_path / "in", [frame(spark, [row(1)]), frame(spark, [row(2)])], "ab")
    (tmp_path / "in" / NAME / "part-c.parquet").write_text("broken")
    _parts(tmp_path / "in", [frame(spark, [row(3)])], "a", OTHER)
    res = _ingest(spark, tmp_path / "in", tmp_path / "out")
    verdicts = {r["file"]: (r["outcome"], r["reason"][:11]) for r in res.outcome.verdicts.collect()}
    assert verdicts == {NAME: ("reject", "unreadable:"), OTHER: ("accept", "all rules p")}


def test_many_parts_are_read_by_several_tasks(spark, tmp_path):
    from shelfgate.sources.catalog import entry_files, read_catalog
    from shelfgate.sources.listing import part_schemas

    spark.range(4000).repartition(40).write.parquet(str(tmp_path / "in" / NAME))
    files = entry_files(spark, str(tmp_path / "in"), read_catalog(spark, str(tmp_path / "in")))
    parts = part_schemas(files)
    assert parts.rdd.getNumPartitions() == 3
    assert parts.select("leaf").distinct().count() == files.count() == 40


def test_merged_types(spark):
    cases = [
        (["int"], "int"), (["int", "bigint"], "bigint"), (["smallint", "float"], "float"), (["int", "float"], "double"),
        (["bigint", "double"], "double"), (["float", "double"], "double"), (["void", "string"], "string"), (["void"], "void"),
        (["date", "timestamp_ntz"], "timestamp_ntz"), (["timestamp_ns", "timestamp_ntz"], "timestamp_ntz"),
        (["timestamp_ns"], "timestamp_ns"), (["date", "timestamp"], "timestamp"),
        (["decimal(10,2)", "decimal(12,4)"], "decimal(12,4)"), (["decimal(38,0)", "decimal(10,2)"], None),
        (["string", "double"], None), (["boolean", "int"], None), (["struct<a:int>", "struct<a:bigint>"], None),
        (["struct<a:int>", "struct<a:int>"], "struct<a:int>"), (["decimal(5,2)", "int"], None)]
    random.Random(1).shuffle(cases)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t array<string>")
    got = {r["i"]: r["m"] for r in df.select("i", merged_type(F.col("t")).alias("m")).collect()}
    assert got == {i: m for i, (_, m) in enumerate(cases)}


def test_group_without_files(spark, tmp_path):
    root = f"{tmp_path}/in"
    os.makedirs(root)
    group = Group((("x", "int"),), (Route((("x", "int"),), (f"file:{root}/a.parquet", f"file:{root}/b.parquet/p1")),
                                    Route((), (f"file:{root}/b.parquet/p2",))), ("a.parquet", "b.parquet"))
    left = group.without({"b.parquet"}, spark, root)
    assert left == Group((("x", "int"),), (Route((("x", "int"),), (f"file:{root}/a.parquet",)),), ("a.parquet",))
    assert group.without({"a.parquet", "b.parquet"}, spark, root) is None


# ---- publication

def _two_files(spark, root):
    frame(spark, [row(1), row(2), row(3, sp=0.1)]).coalesce(1).write.parquet(f"{root}/{NAME}")
    frame(spark, [row(4), row(5)]).coalesce(1).write.parquet(f"{root}/{OTHER}")


def _names(spark, out):
    return sorted(r["Product_Name"] for r in read_unified(spark, str(out)).collect())


def test_running_twice_changes_nothing(spark, tmp_path):
    root, out, q = tmp_path / "in", tmp_path / "out", str(tmp_path / "q")
    _two_files(spark, root)
    first = _ingest(spark, root, out, once=True, quarantine_path=q)
    assert first.ok and first.reason == "ok" and len(first.files) == 2
    assert _names(spark, out) == ["unit 1", "unit 2", "unit 4", "unit 5"]
    assert read_unified(spark, str(out)).schema.fieldNames() == CANONICAL.fieldNames()
    again = _ingest(spark, root, out, once=True, quarantine_path=q)
    assert (again.ok, again.reason, again.files) == (True, "already published", [])
    assert _names(spark, out) == ["unit 1", "unit 2", "unit 4", "unit 5"]
    assert publish.read_published(spark, q, StructType([]), manifest_of=str(out), keep_entry=True).collect()[0]["entry"] == NAME
    # one file comes again with other rows: its earlier ones go, the other file stays as it is
    frame(spark, [row(1), row(9)]).coalesce(1).write.mode("overwrite").parquet(f"{root}/{NAME}")
    third = _ingest(spark, root, out, once=True, quarantine_path=q)
    assert third.files == [NAME]
    assert _names(spark, out) == ["unit 1", "unit 4", "unit 5", "unit 9"]
    assert publish.read_manifest(spark, str(out)).count() == 3


@pytest.mark.parametrize("step", ["stage", "commit"])
def test_a_failure_between_steps_shows_all_or_nothing(spark, tmp_path, monkeypatch, step):
    root, out, q = tmp_path / "in", tmp_path / "out", str(tmp_path / "q")
    _two_files(spark, root)
    real, calls = getattr(publish, step), []

    def broken(*args):
        calls.append(args)
        if step == "commit" or len(calls) == 2:     # survivors are staged, quarantine is not; or all are
            raise RuntimeError("driver lost")
        return real(*args)

    monkeypatch.setattr(I.publish, step, broken)
    with pytest.raises(RuntimeError):
        _ingest(spark, root, out, once=True, quarantine_path=q)
    assert publish.read_published(spark, str(out), CANONICAL).count() == 0
    monkeypatch.setattr(I.publish, step, real)
    assert _ingest(spark, root, out, once=True, quarantine_path=q).ok
    assert _names(spark, out) == ["unit 1", "unit 2", "unit 4", "unit 5"]


def test_a_file_that_an_error_kept_out_is_tried_again(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "in", tmp_path / "out"
    frame(spark, [row(1)]).coalesce(1).write.parquet(f"{root}/{NAME}")
    frame(spark, [row(4)]).drop("Currency").coalesce(1).write.parquet(f"{root}/{OTHER}")
    real = I.ingest_frame
    monkeypatch.setattr(I, "ingest_frame", lambda df, *a, **k: real(df, *a, **k) if "Currency" in df.columns else 1 / 0)
    assert _ingest(spark, root, out, once=True).ok
    assert _names(spark, out) == ["unit 1"]
    monkeypatch.setattr(I, "ingest_frame", real)
    assert _ingest(spark, root, out, once=True).files == [OTHER]
    assert _names(spark, out) == ["unit 1", "unit 4"]


def test_once_and_partitions_exclude_each_other(spark, tmp_path):
    with pytest.raises(ValueError):
        _ingest(spark, tmp_path, tmp_path / "out", once=True, partition_by=["Retailer"])


def test_a_damaged_table_is_not_absent(spark, tmp_path):
    (tmp_path / "t").mkdir()
    assert read_unified(spark, str(tmp_path / "none")) is None
    assert read_unified(spark, str(tmp_path / "t")) is None      # no data file yet
    (tmp_path / "t" / "part-0.parquet").write_text("broken")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        read_unified(spark, str(tmp_path / "t")).count()
