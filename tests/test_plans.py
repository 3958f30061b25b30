"""Plan shape: the reviewed physical plans stay that way."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_plan_shapes(spark):
    from shelfgate.plans.queries import QUERIES

    gate_plan = _plan(QUERIES["gate_survivors"](spark, SF))
    assert "BroadcastHashJoin" in gate_plan
    assert "SortMergeJoin" not in gate_plan and "Window" not in gate_plan

    verdict_plan = _plan(QUERIES["file_verdict"](spark, SF))
    assert "SortMergeJoin" not in verdict_plan and "Window" not in verdict_plan

    audit_plan = _plan(QUERIES["audit_overall"](spark, SF))
    assert "Join" not in audit_plan and "Window" not in audit_plan

    latest_plan = _plan(QUERIES["latest_as_of"](spark, SF))
    assert "Window" not in latest_plan

    dedupe_plan = _plan(QUERIES["dedupe_by_key"](spark, SF))
    assert "SortMergeJoin" not in dedupe_plan and "Window" not in dedupe_plan
    assert "BroadcastHashJoin" in dedupe_plan


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_no_window_beyond_the_broadcast(spark, monkeypatch):
    """Rows that miss the bit map pass through; the others join the repeated keys."""
    from shelfgate.operators import keys
    from shelfgate.plans.queries import QUERIES

    monkeypatch.setattr(keys, "MAX_BROADCAST_BYTES", -1)
    for name in ("gate_survivors", "dedupe_by_key"):
        plan = _plan(QUERIES[name](spark, SF))
        assert "Window" not in plan and "Union" in plan
