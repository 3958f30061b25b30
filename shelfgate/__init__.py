"""shelfgate: Spark-native ingest, quality gate, audit and profile for weekly listing files."""

from .functions.schema import AUDIT_KEYS, CANONICAL, canonical_names, required_names
from .operators.audit import audit, duplicate_rows, duplicate_sample, duplicate_summary, save_report
from .operators.gate import GateResult, gate
from .operators.rules import Rule, default_rules, load_rules, load_rules_spark, parse_rules
from .plans.audit import run_audit
from .plans.explore import explore, profile_report
from .plans.ingest import IngestResult, ingest_frame, ingest_latest_frame, run_ingest
from .streaming.weekly import stream_ingest

__all__ = [
    "AUDIT_KEYS", "CANONICAL", "canonical_names", "required_names",
    "audit", "duplicate_rows", "duplicate_sample", "duplicate_summary", "save_report",
    "GateResult", "gate", "Rule", "default_rules", "load_rules", "load_rules_spark", "parse_rules",
    "run_audit", "explore", "profile_report",
    "IngestResult", "ingest_frame", "ingest_latest_frame", "run_ingest", "stream_ingest",
]
