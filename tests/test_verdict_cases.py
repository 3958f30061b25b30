"""Cases that were wrong once: lineage under awkward roots, number text, rule files, ``mostly``."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from shelfgate.functions.casts import as_double, to_type
from shelfgate.operators.gate import _ok, gate
from shelfgate.operators.rules import default_rules, parse_rules, read_rules_json
from shelfgate.plans.ingest import run_ingest
from shelfgate.sources.catalog import list_entries
from shelfgate.sources.listing import part_schemas, scan_group

from frames import frame, row


@pytest.mark.parametrize("root", ["admin/in", "a b/in", "in/x/in", "listings/2025/listings", "p+q%25/in"])
def test_lineage_and_discovery_are_relative_to_the_root(spark, tmp_path, root):
    folder = f"{tmp_path}/{root}"
    names = [f"{s}_weekly_20240108_101500.parquet" for s in ("cubesmart", "storagemart")]
    for k, name in enumerate(names):
        spark.range(k, k + 1).write.parquet(f"{folder}/{name}")
    entries = {r["path"].rsplit("/", 1)[-1]: r["path"] for r in list_entries(spark, folder + "/").collect()}
    assert sorted(entries) == names
    rows = scan_group(spark, folder, sorted(entries.values())).collect()
    assert sorted((r["Source_File"], r["id"]) for r in rows) == [(n, k) for k, n in enumerate(names)]


def test_type_suffixes_are_no_numbers(spark):
    df = spark.createDataFrame([("12d",), ("1.5F",), ("0x1p3",), (" 12.5 ",), ("1e3",), ("-Infinity",), (".5",)], "v string")
    for c in (to_type(F.col("v"), StringType(), DoubleType()), as_double(F.col("v"), StringType())):
        got = [r[0] for r in df.select(c).collect()]
        assert got == [None, None, None, 12.5, 1000.0, float("-inf"), 0.5]


@pytest.mark.parametrize("text", ['{"a": 1}', '{"expectations": []}', '{"expectations": null}'])
def test_rule_file_without_rules(spark, tmp_path, text):
    path = tmp_path / "rules.json"
    path.write_text(text)
    assert read_rules_json(spark, str(path)).collect() == []


def test_rule_file_with_rules(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"expectations": [
        {"expectation_type": "t", "kwargs": {"column": "c", "min_value": 1, "mostly": 0.9}}, {"expectation_type": "u"}]}))
    assert [tuple(r) for r in read_rules_json(spark, str(path)).collect()] == [
        (1, "t", "c", 1.0, None, 0.9), (2, "u", None, None, None, None)]


def test_mostly_at_the_limit(spark):
    df = spark.createDataFrame([(10, 100), (11, 100), (0, 0)], "f long, n long")
    assert [r[0] for r in df.select(_ok(F.col("f"), F.col("n"), 0.9)).collect()] == [True, False, True]


def _raw_files(spark, root):
    """Three files of one schema, 200 rows each; the third has a damaged data page."""
    names = [f"{s}_weekly_20240108_101500.parquet" for s in ("cubesmart", "smartstopselfstorage", "storagemart")]
    for k, name in enumerate(names):
        df = frame(spark, [row(1000 * k + i) for i in range(200)]).coalesce(1)
        df.write.option("compression", "none").parquet(f"{root}/{name}")
    part = next(p for p in (root / names[2]).iterdir() if p.suffix == ".parquet")
    data = bytearray(part.read_bytes())
    data[4:len(data) // 2] = b"\xff" * (len(data) // 2 - 4)
    part.write_bytes(bytes(data))
    (root / names[2] / f".{part.name}.crc").unlink(missing_ok=True)
    return names


def test_a_damaged_file_is_rejected_alone(spark, tmp_path):
    names = _raw_files(spark, tmp_path / "in")
    res = run_ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), default_rules(), reference_date="2024-01-20")
    got = {r["file"]: (r["outcome"], r["survivors"]) for r in res.outcome.verdicts.collect()}
    assert got == {names[0]: ("accept", 200), names[1]: ("accept", 200), names[2]: ("reject", 0)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400


def test_footers_are_read_by_several_tasks(spark, tmp_path):
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "f"))
    path = next(str(p) for p in (tmp_path / "f").iterdir() if p.suffix == ".parquet")
    files = spark.range(400).select(F.concat(F.lit("n"), F.col("id")).alias("file_name"), F.lit(path).alias("leaf"))
    schemas = part_schemas(files.coalesce(1))
    assert schemas.count() == 400
    assert schemas.rdd.getNumPartitions() == 25


def test_nan_ids_are_missing_ids(spark):
    rules = parse_rules({"expectations": [{"expectation_type": "ExpectColumnValuesToBeUnique", "kwargs": {"column": "id"}}]})
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1), (nan, 2), (3.0, 3)], "id double, n int")
    assert sorted(r["n"] for r in gate(df, rules).survivors().collect()) == [1, 2, 3]
    df = spark.createDataFrame([(nan, 1), (nan, 2), (3.0, 3), (3.0, 4), (5.0, 5)], "id double, n int")
    assert sorted(r["n"] for r in gate(df, rules).survivors().collect()) == [5]


def test_input_columns_named_like_helpers_and_with_dots(spark):
    rules = parse_rules({"expectations": [
        {"expectation_type": "ExpectColumnValuesToBeUnique", "kwargs": {"column": "a.b"}},
        {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "s0"}}]})
    df = spark.createDataFrame([("x", 1, "f", 7), ("x", 2, "f", 8), ("y", None, "f", 9), ("y", 4, "g", 9)],
                               "`a.b` string, s0 int, _file string, nf0 int")
    g = gate(df, rules, file_col="_file")
    assert [tuple(r) for r in g.survivors().collect()] == [("y", 4, "g", 9)]
    assert g.flagged().columns == ["a.b", "s0", "_file", "nf0", "failed_rules"]
    assert {(r["file"], r["outcome"]) for r in g.verdicts().collect()} == {("f", "reject"), ("g", "accept")}
