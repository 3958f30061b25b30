"""Streaming ingest: each run takes only new files; the gate stays per file."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfgate.functions.schema import CANONICAL
from shelfgate.operators.rules import default_rules
from shelfgate.sources.sinks import read_unified
from shelfgate.streaming.weekly import _process, stream_ingest

from frames import RAW_NUM, frame, row


def test_stream_ingest_takes_new_files_once(spark):
    base = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    landing = f"{base}/in"
    os.makedirs(landing)
    frame(spark, [row(1, pid="A"), row(2, pid="A"), row(3)]).coalesce(1).write.parquet(
        f"{landing}/cubesmart_weekly_20250127_181344.parquet")
    frame(spark, [row(4, pid="A"), row(5)]).coalesce(1).write.parquet(
        f"{landing}/storagemart_weekly_20250127_090843.parquet")
    frame(spark, [row(6)]).coalesce(1).write.parquet(f"{landing}/nobody_weekly_20250127_000000.parquet")
    raw = spark.read.parquet(f"{landing}/cubesmart_weekly_20250127_181344.parquet").schema
    assert [f.name for f in raw.fields] == [c.split()[0] for c in RAW_NUM.split(", ")]
    kw = dict(checkpoint_location=f"{base}/ckpt", verdicts_path=f"{base}/verdicts",
              quarantine_path=f"{base}/quarantine",
              sources=["cubesmart", "smartstopselfstorage", "storagemart"])
    q = stream_ingest(spark, landing, raw, f"{base}/out", default_rules(), **kw)
    q.awaitTermination(120)
    out = spark.read.parquet(f"{base}/out")
    # "A" repeats only inside the cubesmart file: both copies fail there, the storagemart "A" passes
    assert sorted(r["Product_Name"] for r in out.collect()) == ["unit 3", "unit 4", "unit 5"]

    frame(spark, [row(7)]).coalesce(1).write.parquet(f"{landing}/cubesmart_weekly_20250203_181358.parquet")
    q = stream_ingest(spark, landing, None, f"{base}/out", default_rules(), **kw)   # schema from the files
    q.awaitTermination(120)
    out = spark.read.parquet(f"{base}/out")
    assert sorted(r["Product_Name"] for r in out.collect()) == ["unit 3", "unit 4", "unit 5", "unit 7"]
    assert sorted(r["Product_Name"] for r in read_unified(spark, f"{base}/out").collect()) == [
        "unit 3", "unit 4", "unit 5", "unit 7"]
    q = spark.read.parquet(f"{base}/quarantine").collect()
    assert sorted(r["Product_Name"] for r in q) == ["unit 1", "unit 2"]
    v = spark.read.parquet(f"{base}/verdicts").where(F.col("outcome") == "repair").collect()
    assert [r["file"] for r in v] == ["cubesmart_weekly_20250127_181344.parquet"]


def test_a_replayed_micro_batch_changes_nothing(spark, tmp_path):
    names = [f"{s}_weekly_20250127_181344.parquet" for s in ("cubesmart", "storagemart")]
    rows = frame(spark, [row(i) for i in range(6)]).withColumn(
        "Source_File", F.when(F.col("Product_ID") < "3", names[0]).otherwise(names[1]))
    out = str(tmp_path / "out")
    run = _process(default_rules(), ["cubesmart", "storagemart"], out, None, str(tmp_path / "q"), CANONICAL, "cast", "x")
    run(rows, 0)
    run(rows, 0)     # replayed whole
    assert read_unified(spark, out).count() == 6
    run(rows.where(F.col("Source_File") == names[0]).limit(2), 1)   # a file comes again, shorter
    assert read_unified(spark, out).count() == 5


def test_a_micro_batch_that_fails_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    from shelfgate.sources import publish

    rows = frame(spark, [row(i) for i in range(3)]).withColumn("Source_File", F.lit("cubesmart_weekly_20250127_181344.parquet"))
    out = str(tmp_path / "out")
    run = _process(default_rules(), ["cubesmart"], out, None, None, CANONICAL, "cast", "x")
    run(rows.limit(1), 0)
    real = publish.commit
    monkeypatch.setattr(publish, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        run(rows, 1)
    assert read_unified(spark, out).count() == 1
    monkeypatch.setattr(publish, "commit", real)
    run(rows, 1)
    assert read_unified(spark, out).count() == 3
