"""Property test: the gate equals a plain-Python model of the rules on random frames."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfgate.operators.gate import gate
from shelfgate.operators.rules import default_rules

from frames import frame, row

RULES = default_rules()
PRICES = [None, float("nan"), 3.99, 4.0, 100.0, 5760.0, 5760.5, 2.39, 2.4, 9644.4, 9644.5]

rows_st = st.lists(
    st.tuples(st.sampled_from(["f1", "f2"]), st.sampled_from([None, "a", "b", "c"]),
              st.sampled_from([None, "x"]), st.sampled_from(PRICES), st.sampled_from(PRICES)),
    min_size=1, max_size=14)


def _model(rows):
    """Per row: the failed rule ids, following the rule semantics directly."""
    out = {}
    for f in {r[0] for r in rows}:
        part = [(i, r) for i, r in enumerate(rows) if r[0] == f]
        ids = [r[1] for _, r in part]
        counts = {v: ids.count(v) for v in ids if v is not None}
        has_dup = any(n > 1 for n in counts.values())
        null_fail = has_dup and ids.count(None) >= 2
        for i, (_, pid, cat, op, sp) in part:
            failed = []
            for rule in RULES:
                if rule.kind == "not_null" and rule.column == "Category_Traversal" and cat is None:
                    failed.append(rule.rule_id)
                elif rule.kind == "unique" and ((pid is not None and counts[pid] > 1) or (pid is None and null_fail)):
                    failed.append(rule.rule_id)
                elif rule.kind == "between":
                    v = op if rule.column == "Original_Price" else sp
                    if v is not None and not math.isnan(v) and (v < rule.min_value or v > rule.max_value):
                        failed.append(rule.rule_id)
            out[f"unit {i}"] = failed
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_st)
def test_gate_matches_model(spark, rows):
    from pyspark.sql import functions as F

    data = [row(i, pid=pid, cat=cat, op=op, sp=sp) for i, (_, pid, cat, op, sp) in enumerate(rows)]
    df = frame(spark, data).withColumn(
        "file", F.element_at(F.array(*[F.lit(r[0]) for r in rows]),
                             F.regexp_extract("Product_Name", r"(\d+)$", 1).cast("int") + 1))
    got = {r["Product_Name"]: list(r["failed_rules"]) for r in gate(df, RULES, file_col="file").flagged().collect()}
    assert got == _model(rows)
