"""Every registered query against its DuckDB SQL (the driver's check, at sf0.001)."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_all_queries_match_sql(spark):
    from oracle_compare import compare

    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "rows-only")}
    assert not bad, bad


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns[0] == "Run_Date" and df.count() > 0


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_key_queries_match_sql_beyond_the_broadcast(spark, monkeypatch):
    """Beyond the broadcast bound, with a bit map full of false hits and hot keys."""
    from oracle_compare import compare

    from shelfgate.operators import keys

    monkeypatch.setattr(keys, "MAX_BROADCAST_BYTES", -1)
    monkeypatch.setattr(keys, "FILTER_BITS", 128)
    monkeypatch.setattr(keys, "HOT_ROWS_FLOOR", 2)
    names = ["rule_unique", "gate_failed_rules", "gate_survivors", "file_verdict", "ingest_file",
             "duplicate_rows", "dedupe_by_key"]
    res = compare(spark, SF, names, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "rows-only")}
    assert not bad, bad
