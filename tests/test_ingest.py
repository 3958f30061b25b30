"""End to end: landing folder -> catalog -> latest per source -> schema groups ->
gate -> conform -> append; then the audit of the written table."""

from __future__ import annotations

import datetime as dt
import json
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfgate.functions.schema import CANONICAL
from shelfgate.operators.audit import audit, report_dict
from shelfgate.operators.rules import DEFAULT_RULE_CONFIG, load_rules
from shelfgate.plans.audit import run_audit
from shelfgate.plans.ingest import run_ingest
from shelfgate.sources.sinks import read_column_log, read_unified

from frames import RAW_NUM, RAW_TEXT, frame, row


def _pandas_file(path, rows, schema_text_prices):
    cols = [c.split()[0] for c in (RAW_TEXT if schema_text_prices else RAW_NUM).split(", ")]
    pdf = pd.DataFrame(rows, columns=cols)
    pdf.to_parquet(path, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)


@pytest.fixture(scope="module")
def landing(spark):
    root = tempfile.mkdtemp(prefix="landing-", dir="/tmp") + "/in"
    import os

    os.makedirs(root)
    # cubesmart: two weeks, text prices, single files written by pandas
    _pandas_file(f"{root}/cubesmart_weekly_20250127_181344.parquet",
                 [row(i, text=True, op="50") for i in range(3)], True)
    _pandas_file(f"{root}/cubesmart_weekly_20250203_181358.parquet",
                 [row(10 + i, text=True, op=p) for i, p in enumerate(["50", "$12.00", None, "70"])], True)
    # smartstop: double prices, a repeated id and an extra column; a Spark-written folder
    df = frame(spark, [row(20, pid="X"), row(21, pid="X"), row(22), row(23, sp=1.0)])
    df = df.withColumn("Promo_Code", F.lit("p"))
    df.coalesce(1).write.parquet(f"{root}/smartstopselfstorage_weekly_20250203_090120.parquet")
    # storagemart: the chosen file lacks a required column; a newer one is after the date
    frame(spark, [row(30), row(31)]).drop("Brand").coalesce(1).write.parquet(
        f"{root}/storagemart_weekly_20250127_090843.parquet")
    frame(spark, [row(40)]).coalesce(1).write.parquet(f"{root}/storagemart_weekly_20250210_061303.parquet")
    # noise
    frame(spark, [row(50)]).coalesce(1).write.parquet(f"{root}/othershop_weekly_20250203_000000.parquet")
    with open(f"{root}/README.txt", "w") as fh:
        fh.write("not data")
    return root


def test_run_ingest_end_to_end(spark, landing):
    out = landing.replace("/in", "/out")
    rules_path = landing.replace("/in", "/rules.json")
    with open(rules_path, "w") as fh:
        json.dump(DEFAULT_RULE_CONFIG, fh)
    rules = load_rules(rules_path)
    res = run_ingest(spark, landing, f"{out}/unified.parquet", rules,
                     reference_date=dt.date(2025, 2, 5), column_log_path=f"{out}/column_log.parquet",
                     detection_time="2025-02-05 12:00:00", quarantine_path=f"{out}/quarantine.parquet")
    assert res.ok, res.reason
    quarantined = spark.read.parquet(f"{out}/quarantine.parquet")
    assert sorted(r["Product_Name"] for r in quarantined.collect()) == [
        "unit 20", "unit 21", "unit 23", "unit 30", "unit 31"]     # repeated id, low price, missing Brand
    assert dict(quarantined.dtypes)["Original_Price"] == "string"
    assert sorted(res.files) == ["cubesmart_weekly_20250203_181358.parquet",
                                 "smartstopselfstorage_weekly_20250203_090120.parquet",
                                 "storagemart_weekly_20250127_090843.parquet"]
    verdicts = {r["file"]: r["outcome"] for r in res.outcome.verdicts.collect()}
    assert verdicts == {"cubesmart_weekly_20250203_181358.parquet": "accept",
                        "smartstopselfstorage_weekly_20250203_090120.parquet": "repair",
                        "storagemart_weekly_20250127_090843.parquet": "reject"}
    table = read_unified(spark, f"{out}/unified.parquet")
    assert table.columns == CANONICAL.fieldNames()
    names = sorted(r["Product_Name"] for r in table.collect())
    assert names == ["unit 10", "unit 11", "unit 12", "unit 13", "unit 22"]
    prices = {r["Product_Name"]: r["Original_Price"] for r in table.collect()}
    assert prices["unit 10"] == 50.0 and prices["unit 11"] is None and prices["unit 13"] == 70.0
    log = read_column_log(spark, f"{out}/column_log.parquet").collect()
    assert [(r["file_name"], r["new_column"]) for r in log] == [
        ("smartstopselfstorage_weekly_20250203_090120.parquet", "Promo_Code")]

    rep = report_dict(audit(table, checked_at="2025-02-05 12:00:00"))
    assert rep["overall_passed"] is True
    assert rep["duplicate_check"]["details"] == {"total_records": 5, "unique_records": 5, "duplicate_records": 0}

    # a rerun appends again: the audit now finds every key twice
    res2 = run_ingest(spark, landing, f"{out}/unified.parquet", rules, reference_date=dt.date(2025, 2, 5))
    assert res2.ok
    rep2 = report_dict(run_audit(spark, f"{out}/unified.parquet", checked_at="2025-02-05 13:00:00"))
    assert rep2["duplicate_check"]["details"]["duplicate_records"] == 5
    assert rep2["overall_passed"] is False
    sample = rep2["duplicate_check"]["details"]["sample_duplicates"]
    assert len(sample) == 5 and sample[0]["Retailer"] == "shop"
    assert sample[0]["Run_Date"].startswith("2025-01-27T00:00:00")


def test_run_ingest_partition_overwrite_is_rerun_safe(spark, landing):
    out = landing.replace("/in", "/out-part") + "/unified.parquet"
    rules = load_rules_default()
    for _ in range(2):
        res = run_ingest(spark, landing, out, rules, reference_date=dt.date(2025, 2, 5),
                         partition_by=["Retailer"], overwrite_partitions=True)
        assert res.ok
    assert read_unified(spark, out).count() == 5


def test_run_ingest_no_files(spark):
    root = tempfile.mkdtemp(prefix="empty-", dir="/tmp")
    with open(f"{root}/x_weekly_20250101_000000.parquet.tmp", "w") as fh:
        fh.write("")
    frame(spark, [row(1)]).write.parquet(f"{root}/unknown_weekly_20250101_000000.parquet")
    res = run_ingest(spark, root, f"{root}/out", load_rules_default(), reference_date="2025-02-05")
    assert not res.ok and res.reason == "no files found"


def load_rules_default():
    from shelfgate.operators.rules import default_rules

    return default_rules()


def test_missing_output_is_none(spark):
    assert read_unified(spark, "/tmp/definitely-not-here-" + str(dt.datetime.now().timestamp())) is None


def test_run_ingest_unreadable_file_rejected(spark):
    root = tempfile.mkdtemp(prefix="landing-bad-", dir="/tmp") + "/in"
    import os

    os.makedirs(root)
    frame(spark, [row(1), row(2)]).coalesce(1).write.parquet(f"{root}/cubesmart_weekly_20250127_181344.parquet")
    with open(f"{root}/storagemart_weekly_20250127_090843.parquet", "w") as fh:
        fh.write("broken")
    res = run_ingest(spark, root, root.replace("/in", "/out"), load_rules_default(),
                     reference_date="2025-02-05")
    assert res.ok
    v = {r["file"]: (r["outcome"], r["reason"][:11]) for r in res.outcome.verdicts.collect()}
    assert v == {"cubesmart_weekly_20250127_181344.parquet": ("accept", "all rules p"),
                 "storagemart_weekly_20250127_090843.parquet": ("reject", "unreadable:")}


def test_run_ingest_reads_nanosecond_timestamps(spark):
    """pandas writes datetime64[ns] as parquet TIMESTAMP(NANOS); Spark reads it only as a long."""
    import os

    import pyarrow.parquet as pq

    root = tempfile.mkdtemp(prefix="landing-ns-", dir="/tmp") + "/in"
    os.makedirs(root)
    cols = [c.split()[0] for c in RAW_NUM.split(", ")]
    pdf = pd.DataFrame([row(1), row(2)], columns=cols)
    pdf["Run_Date"] = pd.to_datetime(["2025-01-27 10:11:12.123456999", "2025-01-27 00:00:00.000000001"])
    path = f"{root}/cubesmart_weekly_20250127_181344.parquet"
    pdf.to_parquet(path, index=False)
    assert str(pq.read_schema(path).field("Run_Date").type) == "timestamp[ns]"
    res = run_ingest(spark, root, root.replace("/in", "/out"), load_rules_default(), reference_date="2025-02-05")
    assert res.ok, res.reason
    got = sorted(r["Run_Date"] for r in read_unified(spark, root.replace("/in", "/out")).collect())
    assert got == [dt.datetime(2025, 1, 27, 0, 0), dt.datetime(2025, 1, 27, 10, 11, 12, 123456)]


def test_run_ingest_error_rejects_only_that_group(spark, landing, monkeypatch):
    """An error while gating one schema group rejects its files; the others are ingested."""
    from shelfgate.plans import ingest as I

    real = I.ingest_frame

    def flaky(df, *a, **kw):
        if any("smartstop" in f for f in df.inputFiles()):
            raise RuntimeError("corrupt page")
        return real(df, *a, **kw)

    monkeypatch.setattr(I, "ingest_frame", flaky)
    out = landing.replace("/in", "/out-err") + "/unified.parquet"
    res = run_ingest(spark, landing, out, load_rules_default(), reference_date=dt.date(2025, 2, 5))
    assert res.ok
    v = {r["file"]: (r["outcome"], r["reason"][:12]) for r in res.outcome.verdicts.collect()}
    assert v["smartstopselfstorage_weekly_20250203_090120.parquet"] == ("reject", "error: Runti")
    assert v["cubesmart_weekly_20250203_181358.parquet"][0] == "accept"
    assert read_unified(spark, out).count() == 4
