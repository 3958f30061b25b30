"""Whole audit of the unified table (the reference's ``run_validation``)."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.schema import AUDIT_KEYS, CANONICAL
from ..operators.audit import (
    audit,
    available_keys,
    save_report,
    unavailable_report,
    with_duplicate_sample,
)
from ..session import path_exists
from ..sources.footers import column_facts
from ..sources.publish import manifest_path
from ..sources.sinks import read_unified


log = logging.getLogger("shelfgate.audit")


def run_audit(spark: SparkSession, table_path: str, *, schema: StructType = CANONICAL,
              keys: list[str] = AUDIT_KEYS, checked_at: str | None = None,
              report_path: str | None = None, sample: int = 5) -> DataFrame:
    """Load the table, audit it, optionally save the JSON report; returns the one-row report.

    A missing table gives the default report (every check false, no overall
    verdict), like the reference; a table that is there but cannot be read
    raises. Row and null counts come from the table's footers where they tell
    them. When duplicates exist, the first ``sample`` duplicated keys go into
    the report.
    """
    df = read_unified(spark, table_path)
    if df is None:
        log.error("table not found: %s", table_path)
        report = unavailable_report(spark, checked_at)
    else:
        # a published table holds replaced rows as well: its footers tell too much
        plain = not path_exists(spark, manifest_path(table_path))
        report = audit(df, schema, keys, checked_at=checked_at,
                       known=column_facts(spark, table_path) if plain else None)
        if sample and available_keys(df, keys):
            dups = report.select("duplicate_records").first()[0]
            if dups:
                report = with_duplicate_sample(report, df, keys, sample)
    if report_path:
        save_report(report, report_path)
    return report
