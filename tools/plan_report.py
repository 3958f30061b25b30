"""Write PLANS.md: the physical plan tree and scan schemas of the core queries.

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

LARGE = ["gate_survivors", "audit_overall", "duplicate_summary", "dedupe_by_key",
         "constraint_unique_per_group"]
CORE = ["gate_survivors", "file_verdict", "rule_report_per_file", "ingest_unified", "audit_overall", "duplicate_summary",
        "duplicate_rows", "dedupe_by_key", "profile_dataset", "profile_assoc_categorical",
        "latest_as_of", "catalog_newest_first", "schema_missing", "constraint_unique_per_group", "key_history",
        "footer_missing"]


def plan_text(df) -> str:
    jplan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    tree, details = jplan.split("\n\n", 1) if "\n\n" in jplan else (jplan, "")
    scans = [ln.strip() for ln in details.splitlines() if re.match(r"\s*(ReadSchema|PushedFilters):", ln)]
    return tree.strip() + "\n\n" + "\n".join(scans)


def ingest_scans(spark, sf: str, log: str) -> list[str]:
    """What run_ingest reads of the chosen files, from the event log: the columns of each scan."""
    from shelfgate.operators.rules import default_rules
    from shelfgate.plans.ingest import run_ingest
    from shelfgate.session import scratch_path
    from shelfgate.sources.fixtures import EVENT_SOURCES, listing

    base = scratch_path(spark, "plan-ingest")
    listing(spark, sf).coalesce(2).write.parquet(f"{base}/landing/{EVENT_SOURCES[0]}_weekly_20240108_000000.parquet")
    run_ingest(spark, base + "/landing", base + "/unified", default_rules(), reference_date="2024-01-20",
               sources=EVENT_SOURCES, quarantine_path=base + "/quarantine")
    time.sleep(2)
    plans: dict[int, str] = {}
    for name in os.listdir(log):
        with open(os.path.join(log, name), errors="replace") as fh:
            for line in fh:
                event = json.loads(line)
                if "physicalPlanDescription" in event:
                    plans[event["executionId"]] = event["physicalPlanDescription"]
    found = []
    for k in sorted(plans):
        ran = plans[k].split("== Initial Plan ==")[0]   # the plan that ran stands first
        for block in re.split(r"\n(?=\(\d+\) )", plans[k]):
            m = re.match(r"\((\d+)\) Scan parquet", block)
            if m and "/landing/" in block and f"Scan parquet  ({m[1]})" in ran:
                found.append(re.search(r"ReadSchema: (.*)", block)[1])
    return found


def main() -> None:
    # for ingest_scans: the event log goes to a folder of its own
    log = tempfile.mkdtemp(prefix="plan-events-", dir="/tmp")
    os.environ["PYSPARK_SUBMIT_ARGS"] = (f"--conf spark.eventLog.enabled=true --conf spark.eventLog.dir=file://{log} "
                                         "--conf spark.eventLog.rolling.enabled=false --conf spark.eventLog.compress=false "
                                         "--conf spark.eventLog.buffer.kb=1k pyspark-shell")
    from shelfgate.plans.queries import QUERIES
    from shelfgate.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    scans = ingest_scans(spark, sf, log)
    out = ["# Physical plans of the core queries",
           "",
           f"Generated by `python tools/plan_report.py {sf}` (AQE on; the plan is the initial",
           "adaptive plan). Materialized helper tables (repeated keys, per-file facts) appear",
           "as small parquet scans under the shared folder.",
           ""]
    for name in CORE:
        df = QUERIES[name](spark, sf)
        out += [f"## {name}", "", "```", plan_text(df), "```", ""]
    out += ["# Scans of the chosen files in `run_ingest`", "",
            "From the event log of an ingest with a quarantine path: keys, facts and rows, once each. Verdicts, survivors,",
            "quarantine and the rule report come from what these three leave.", "", "```", *scans, "```", ""]
    # beyond the broadcast bound (forced here)
    from shelfgate.operators import keys

    keys.MAX_BROADCAST_BYTES = -1
    out += ["# Beyond the broadcast bound", "",
            "The same queries where the repeated keys exceed `keys.MAX_BROADCAST_BYTES` (forced here):",
            "rows that miss the bit map pass through, the others join the repeated keys.", ""]
    for name in LARGE:
        df = QUERIES[name](spark, sf)
        out += [f"## {name} (beyond the bound)", "", "```", plan_text(df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
