"""Facts from footers against scans, and profile corners on literal rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfgate.operators import audit as A
from shelfgate.operators import constraints as K
from shelfgate.operators import profile as P
from shelfgate.sources.footers import column_facts

NAN = float("nan")
SCHEMA = ("i int, l long, s string, d double, b boolean, day date, at timestamp, wall timestamp_ntz, dec decimal(12,3), "
          "empty string, one string, long string, big decimal(38,2), a array<int>, bin binary")


def _rows(n, shift=0):
    out = []
    for k in range(n):
        none = k % 7 == 0
        out.append((None if none else k - 50 + shift, (k + shift) * 2 ** 40 - 2 ** 62, f"é{k % 5}" if not none else None,
                    NAN if k % 3 == 0 else k / 4 - 9, k % 2 == 0, dt.date(1960, 1, 1) + dt.timedelta(k + shift),
                    dt.datetime(2001, 2, 3, 4, 5, 6, 789 + k), dt.datetime(1950, 1, 1) + dt.timedelta(microseconds=k),
                    Decimal(k - 30) / 8, None, "x", "z" * 100, Decimal(k), [1], b"q"))
    return out


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "t")
    spark.createDataFrame(_rows(300), SCHEMA).repartition(3).write.option("parquet.block.size", 2048).parquet(path)
    # a file that lacks columns, and one without rows
    spark.createDataFrame(_rows(40, 500), SCHEMA).drop("i", "one").coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def _read(spark, path):
    return spark.read.option("mergeSchema", "true").parquet(path)


def _same(a, b):
    return Counter(map(repr, a.collect())) == Counter(map(repr, b.collect()))


def test_facts_equal_a_scan(spark, table):
    df = _read(spark, table).select(*[c.split()[0] for c in SCHEMA.split(", ")])
    known = column_facts(spark, table)
    assert {c for c, f in known.items() if f.nulls is not None} >= {"l", "s", "d", "b", "day", "wall", "dec", "empty"}
    assert known["l"].rows == 340 and known["empty"].nulls == 340
    assert _same(P.missing(df, known), P.missing(df))
    assert _same(P.constant_columns(df, known), P.constant_columns(df))
    assert {r["column"] for r in P.constant_columns(df, known).collect()} == {"one", "long", "a", "bin"}
    numbers = ["i", "l", "d", "dec", "big"]
    assert _same(P.price_bounds(df, numbers, 0.2, known), P.price_bounds(df, numbers, 0.2))
    assert _same(A.null_counts(df, df.columns, known), A.null_counts(df, df.columns))
    keys = ["l", "s"]
    assert _same(A.audit(df, keys=keys, known=known), A.audit(df, keys=keys))


def test_what_footers_tell_is_not_scanned(spark, table):
    df = _read(spark, table).select("l", "s", "b", "day", "wall", "dec", "empty")
    known = column_facts(spark, table)
    for out in (P.missing(df, known), A.null_counts(df, df.columns, known), P.price_bounds(df, ["l", "dec"], 0.2, known),
                P.constant_columns(df, known)):
        assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()
    plan = P.missing(_read(spark, table).select("l", "d", "s"), known)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<d:double>" in plan      # NaN is not in the footers


def test_a_file_that_tells_nothing_makes_all_unknown(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "t"))
    assert column_facts(spark, str(tmp_path / "t"))["id"].nulls == 0
    (tmp_path / "t" / "other.parquet").write_text("broken")
    files = str(tmp_path / "t")
    from shelfgate.sources import footers as X

    found = X.table_files(spark, files).mapInPandas(X._statistics, X._ROW).where("column IS NULL").count()
    assert found == 1


def test_constants_without_order(spark):
    df = spark.createDataFrame([({"k": 1}, [1, 2], b"x", None), ({"k": 1}, [1, 2], b"x", None)],
                               "m map<string,int>, a array<int>, b binary, n string")
    assert {r["column"] for r in P.constant_columns(df).collect()} == {"m", "a", "b"}
    assert P.constant_columns(df.select("n")).collect() == []
    assert P.constant_columns(df.select()).collect() == []


def test_correlation_leaves_nan_out_by_pair(spark):
    rows = [(1.0, 2.0, 1), (2.0, 4.0, 2), (NAN, 7.0, 3), (3.0, NAN, 4), (4.0, 8.0, 5), (None, 1.0, 6)]
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in
           P.numeric_correlation(spark.createDataFrame(rows, "a double, b double, c int")).collect()}
    assert math.isclose(got["a", "b"], 1.0) and all(not math.isnan(v) for v in got.values())
    xs = [(a, c) for a, _, c in rows if a is not None and not math.isnan(a)]
    mx, my = (sum(v) / len(xs) for v in zip(*xs))
    r = sum((x - mx) * (y - my) for x, y in xs) / math.sqrt(sum((x - mx) ** 2 for x, _ in xs) * sum((y - my) ** 2 for _, y in xs))
    assert math.isclose(got["a", "c"], r)


def test_awkward_column_names(spark):
    df = spark.createDataFrame([("x", 1.0, True), ("y", None, True)], "`a``b` string, `c.d` double, `e f` boolean")
    assert {r["column"]: r["kind"] for r in P.kinds(df).collect()} == {
        "a`b": "Categorical", "c.d": "Numeric", "e f": "Boolean"}
    assert {r["column"]: r["n_missing"] for r in P.missing(df).collect()} == {"a`b": 0, "c.d": 1, "e f": 0}
    assert [r["column"] for r in P.constant_columns(df).collect()] == ["c.d", "e f"]
    assert P.dataset_summary(df).first()["missing_cells"] == 1


def test_nan_is_missing_for_the_constraint_too(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,), (2.0,)], "v double")
    r = K.missing_rates(df, {"v": 0.4, "absent": 0.1}).collect()
    assert [(x["column"], x["missing_rate"], x["passed"]) for x in r] == [("v", 0.5, False)]
    assert K.missing_rates(df, {"absent": 0.1}).collect() == []


def _cramers_v(pairs):
    pairs = [(a, b) for a, b in pairs if a is not None and b is not None]
    n, na, nb, nab = len(pairs), Counter(a for a, _ in pairs), Counter(b for _, b in pairs), Counter(pairs)
    k = min(len(na), len(nb)) - 1
    s = sum(c * c / (na[a] * nb[b]) for (a, b), c in nab.items())
    return (n, math.sqrt(max(n * (s - 1), 0) / (n * k)) if k > 0 else None)


@pytest.mark.parametrize("bits", [None, 64])
def test_association_with_values_that_occur_once(spark, monkeypatch, bits):
    """Unique, nearly unique, repeated and constant columns, nulls; with a bit map that takes all for repeated."""
    from shelfgate.operators import keys

    monkeypatch.setattr(P, "SINGLES_FROM", 3)
    if bits:
        monkeypatch.setattr(keys, "FILTER_BITS", bits)
    rows = [(f"u{k}", f"n{k // 2}" if k % 9 == 0 else f"n{k}", f"r{k % 7}", None if k % 5 else f"h{k % 3}", "c", k % 2 == 0,
             f"p{k * k % 23}" if k % 4 else None) for k in range(200)]
    names = ["unique", "nearly", "repeated", "holes", "constant", "flag", "many"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'boolean' if n == 'flag' else 'string'}" for n in names))
    got = {(r["column_a"], r["column_b"]): (r["n"], r["cramers_v"]) for r in P.categorical_association(df, names).collect()}
    for i, a in enumerate(names):
        for j, b in enumerate(names[i + 1:], i + 1):
            n, v = _cramers_v([(r[i], r[j]) for r in rows])
            assert got[a, b][0] == n and (got[a, b][1] is None if v is None else math.isclose(got[a, b][1], v, abs_tol=1e-9)), (a, b)
    assert len(got) == 21


def test_unique_columns_make_no_cells(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("u"), (F.col("id") % 3).cast("string").alias("r"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("w"))
    out = P.categorical_association(df, {"u": 20_000, "r": 3, "w": 20_000})
    assert {(r["column_a"], r["column_b"], round(r["cramers_v"], 9)) for r in out.collect()} == {
        ("u", "r", 1.0), ("u", "w", 1.0), ("r", "w", 1.0)}
