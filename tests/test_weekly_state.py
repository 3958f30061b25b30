"""The merged state of weeks against a scan of all of them."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from shelfgate.operators import profile as P
from shelfgate.operators.weekly_state import WeeklyProfile


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    return spark.range(30_000).select(
        (i % 5).cast("string").alias("week"), F.when(i % 11 != 0, (i % 7).cast("string")).alias("few"),
        F.when(i % 10 == 3, F.lit(float("nan"))).when(i % 4 != 0, F.pow(i % 997, F.lit(2.0))).alias("number"),
        F.sha2(i.cast("string"), 256).alias("many"), (i % 2 == 0).alias("flag"), F.lit(None).cast("string").alias("empty"),
        F.when(i % 5 == 4, i.cast("string")).otherwise((i % 3).cast("string")).alias("late"), F.array(i).alias("nested"), i.cast("int").alias("a`.b"))


@pytest.fixture(scope="module")
def weeks(spark, table, tmp_path_factory):
    state = WeeklyProfile(spark, str(tmp_path_factory.mktemp("weeks") / "w"))
    for w in range(5):
        state.add(table.where(F.col("week") == str(w)), str(w))
    state.add(table.where("week = '2'"), "2")    # again: replaced, not added
    return state


def test_merged_equals_a_scan(table, weeks):
    got = {r["column"]: r for r in weeks.merged().collect()}
    assert list(got) == table.columns and weeks.weeks() == list("01234")
    assert {c: r["n_missing"] for c, r in got.items()} == {r["column"]: r["n_missing"] for r in P.missing(table).collect()}
    assert all(r["rows"] == 30_000 for r in got.values())
    exact = {r["column"]: r["n_distinct"] for r in P.column_stats(table).collect()}
    for c in ("few", "flag", "week", "empty"):
        assert (got[c]["n_distinct"], got[c]["distinct_exact"]) == (exact[c], True)
    for c in ("many", "late"):     # one week of "late" has too many levels
        assert not got[c]["distinct_exact"] and abs(got[c]["n_distinct"] / exact[c] - 1) < 0.05
    seen = table.where("number IS NOT NULL AND NOT isnan(number)").agg(F.min("number"), F.max("number"), F.avg("number"), F.count("number")).first()
    r = got["number"]
    assert (r["low"], r["high"]) == (seen[0], seen[1]) and math.isclose(r["mean"], seen[2])
    below = table.where(f"number <= {r['median']} AND NOT isnan(number)").count()
    assert abs(below / seen[3] - 0.5) < 0.02
    assert got["a`.b"]["high"] == 29_999 and got["nested"]["low"] is None and got["nested"]["n_distinct"] is None


def test_value_counts_are_exact(table, weeks):
    got = {(r["column"], r["value"]): r["n"] for r in weeks.value_counts().collect()}
    assert {c for c, _ in got} == {"week", "few", "flag"}
    assert {v: n for (c, v), n in got.items() if c == "few"} == {
        r["few"]: r["count"] for r in table.where("few IS NOT NULL").groupBy("few").count().collect()}


def test_no_weeks_and_an_empty_week(spark, table, tmp_path):
    state = WeeklyProfile(spark, str(tmp_path / "w"))
    assert state.weeks() == [] and state.merged().collect() == [] and state.value_counts().collect() == []
    state.add(table.where("false"), "0")
    rows = {r["column"]: r for r in state.merged().collect()}
    assert rows["few"]["rows"] == 0 and rows["few"]["n_distinct"] == 0 and rows["number"]["median"] is None
