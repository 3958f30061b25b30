"""Audit of a unified table: schema, types, duplicate keys, nulls.

The reference runs about 13 separate jobs. Here schema and type checks read
only ``df.schema`` (no job); totals and null counts are one map-side
aggregation, and the duplicate count comes from the repeated keys alone
(hash-first, exact), so distinct keys never cross the shuffle as text.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.schema import AUDIT_KEYS, CANONICAL, col, free_prefix, required_names, types_compatible
from ..session import materialize
from ..sources.footers import Facts
from .keys import attach_repeats, repeated_keys
from .profile import one_row


log = logging.getLogger("shelfgate.audit")


def available_keys(df: DataFrame, keys: list[str]) -> list[str]:
    return [k for k in keys if k in df.columns]


def _surplus(df: DataFrame, keys: list[str]) -> int:
    """Rows beyond the first of each key (null parts equal), via repeated keys."""
    r = repeated_keys(df, keys, nulls_equal=True).agg(F.sum(F.col("_n") - 1).alias("d")).first()
    return int(r["d"] or 0)


def duplicate_summary(df: DataFrame, keys: list[str] = AUDIT_KEYS) -> DataFrame:
    """(total_records, unique_records, duplicate_records, passed); null keys are equal.

    The total is a map-side count and the surplus rows come from the repeated
    keys alone (hash-first, exact), so distinct keys never cross the shuffle
    as text.
    """
    ks = available_keys(df, keys)
    if not ks:
        raise ValueError("no key column present for the duplicate check")
    surplus = _surplus(df, ks)
    counts = df.agg(F.count(F.lit(1)).cast("long").alias("total_records")).select(
        "total_records", (F.col("total_records") - F.lit(surplus)).alias("unique_records"))
    return counts.select(
        "total_records", "unique_records",
        (F.col("total_records") - F.col("unique_records")).alias("duplicate_records"),
        (F.col("total_records") == F.col("unique_records")).alias("passed"))


def duplicate_rows(df: DataFrame, keys: list[str] = AUDIT_KEYS, limit: int | None = 10,
                   order: list[str] | None = None) -> DataFrame:
    """Rows whose key occurs more than once, with ``dup_count``; first ``limit`` by key.

    The order is keys, then ``order`` (default: all other columns) so the
    sample is deterministic. Null key parts are equal (``GROUP BY``).

    Plan: the repeated keys come from a map-side combined aggregation over
    the key columns. With a limit, the first ``limit`` rows in key order can
    only carry the first ``limit`` repeated keys, so only those are kept
    and broadcast; without one, see :func:`keys.attach_repeats`.
    """
    ks = available_keys(df, keys)
    rest = order if order is not None else [c for c in df.columns if c not in ks]
    rk = repeated_keys(df, ks, nulls_equal=True)
    if limit is not None:
        rk = rk.orderBy(*[col(c).asc_nulls_first() for c in ks]).limit(limit)
    rk = materialize(rk, "repeated-keys")
    flagged = attach_repeats(df, ks, rk, "dup_count", nulls_equal=True).where(F.col("dup_count") > 1)
    if limit is None:
        return flagged
    return flagged.orderBy(*[col(c).asc_nulls_first() for c in ks + rest]).limit(limit)


def duplicate_sample(df: DataFrame, keys: list[str] = AUDIT_KEYS, limit: int = 5) -> DataFrame:
    """First ``limit`` duplicated keys in key order, with their row count (null parts equal).

    Built on the repeated keys (hash-first), then a top-k.
    """
    ks = available_keys(df, keys)
    return (repeated_keys(df, ks, nulls_equal=True).withColumnRenamed("_n", "dup_count")
            .orderBy(*[col(c).asc_nulls_first() for c in ks]).limit(limit))


def with_duplicate_sample(report: DataFrame, df: DataFrame, keys: list[str], limit: int = 5) -> DataFrame:
    """Add ``sample_duplicates`` (first ``limit`` duplicated keys) to a one-row report.

    The sample is at most ``limit`` rows, read once and embedded as a typed literal.
    """
    ks = available_keys(df, keys)
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = duplicate_sample(df, ks, limit).collect()
    entries = [F.struct(*[F.lit(r[k]).cast(types[k]).alias(k) for k in ks]) for r in rows]
    sample = F.array(*entries) if entries else F.array().cast(
        "array<struct<" + ",".join(f"`{k}`:{types[k].simpleString()}" for k in ks) + ">>")
    return report.withColumn("sample_duplicates", sample)


def dedupe_by_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order`` (default: the other columns).

    Rows whose key does not repeat pass through without a shuffle; only the
    rows of repeated keys are reduced with ``min`` over a struct, a partial
    aggregate, so a hot key is combined on the map side.
    """
    rest = order if order is not None else [c for c in df.columns if c not in keys]
    others = [c for c in df.columns if c not in keys]
    pick = F.min(F.struct(*[col(c) for c in rest + [o for o in others if o not in rest]]))

    def reduce_(frame: DataFrame) -> DataFrame:
        return frame.groupBy(*[col(k) for k in keys]).agg(pick.alias("_r")).select(
            *[col(c) if c in keys else F.col("_r").getField(c).alias(c) for c in df.columns])

    rk = materialize(repeated_keys(df, keys, nulls_equal=True), "repeated-keys")
    mark = free_prefix(df.columns) + "dup"
    flagged = attach_repeats(df, keys, rk, mark, nulls_equal=True)
    singles = flagged.where(F.col(mark) == 1).select(*[col(c) for c in df.columns])
    return singles.unionByName(reduce_(flagged.where(F.col(mark) > 1).select(*[col(c) for c in df.columns])))


def null_counts(df: DataFrame, columns: list[str] | None = None, known: dict[str, Facts] | None = None) -> DataFrame:
    """(column, null_count) for each listed column that has nulls (one pass over the columns that the
    table's footers, ``known``, do not tell)."""
    cols = [c for c in (columns or required_names()) if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, null_count long")
    nulls, scanned = _nulls(cols, known)
    stacked = one_row(df, scanned).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), n.cast("long").alias("null_count")) for c, n in nulls.items()])))
    return stacked.where(F.col("null_count") > 0)


def _nulls(columns: list[str], known: dict[str, Facts] | None) -> tuple[dict[str, Column], list[Column]]:
    """The null count of each column, a literal where ``known`` tells it, and the aggregates for the others."""
    counts, scanned = {}, []
    for i, c in enumerate(columns):
        facts = (known or {}).get(c)
        if facts and facts.nulls is not None:
            counts[c] = F.lit(facts.nulls)
        else:
            scanned.append(F.count_if(col(c).isNull()).alias(f"_z{i}"))
            counts[c] = F.col(f"_z{i}")
    return counts, scanned


def schema_findings(df: DataFrame, schema: StructType = CANONICAL, required: list[str] | None = None):
    """Plan-time schema and type findings from ``df.schema`` (no job)."""
    cols = set(df.columns)
    missing = sorted(set(required or required_names(schema)) - cols)
    extra = sorted(cols - set(schema.fieldNames()))
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    mismatches = [
        {"column": f.name, "expected_type": f.dataType.simpleString(), "actual_type": actual[f.name]}
        for f in schema.fields
        if f.name in actual and not types_compatible(actual[f.name], f.dataType.simpleString())
    ]
    return missing, extra, mismatches


def audit(df: DataFrame, schema: StructType = CANONICAL, keys: list[str] = AUDIT_KEYS,
          required: list[str] | None = None, checked_at: str | None = None,
          known: dict[str, Facts] | None = None) -> DataFrame:
    """One-row audit report (the four checks, each with details, and the verdict).

    Keys missing from ``df`` are dropped from the duplicate key; with no key
    column left the duplicate check fails with ``duplicate_error`` set. Row
    and null counts that the table's footers tell (``known``) are not scanned.
    """
    req = required or required_names(schema)
    missing, extra, mismatches = schema_findings(df, schema, req)
    ks = available_keys(df, keys)
    present_req = [c for c in req if c in df.columns]
    nulls, scanned = _nulls(present_req, known)
    # totals and null counts are map-side counts; the unique count subtracts the
    # surplus rows of repeated keys; without a key column it is unknown
    surplus = _surplus(df, ks) if ks else None
    rows = next((F.lit(f.rows) for f in (known or {}).values()), None)
    total = one_row(df, ([] if rows is not None else [F.count(F.lit(1)).alias("_n")]) + scanned)
    total = total.select((F.col("_n") if rows is None else rows).cast("long").alias("total_records"),
                         *[n.cast("long").alias(f"_z{i}") for i, n in enumerate(nulls.values())])
    unique = (F.col("total_records") - F.lit(surplus)) if surplus is not None else F.lit(None)
    totals = total.select("total_records", unique.cast("long").alias("unique_records"),
                          *[F.col(f"_z{i}") for i in range(len(present_req))])
    null_text = F.concat_ws(",", *[
        F.when(F.col(f"_z{i}") > 0, F.concat(F.lit(f"{c}="), F.col(f"_z{i}").cast("string")))
        for i, c in enumerate(present_req)]) if present_req else F.lit("")
    any_null = F.lit(False)
    for i in range(len(present_req)):
        any_null = any_null | (F.col(f"_z{i}") > 0)
    # ";" between entries: type names such as decimal(10,2) contain commas
    mism_text = ";".join(f"{m['column']}:{m['expected_type']}->{m['actual_type']}" for m in mismatches)
    dup_ok = F.coalesce(F.col("total_records") == F.col("unique_records"), F.lit(False))
    out = totals.select(
        F.lit(not missing).alias("schema_passed"),
        F.lit(",".join(missing)).alias("missing_columns"),
        F.lit(",".join(extra)).alias("extra_columns"),
        F.lit(not mismatches).alias("types_passed"),
        F.lit(mism_text).alias("type_mismatches"),
        "total_records", "unique_records",
        (F.col("total_records") - F.col("unique_records")).alias("duplicate_records"),
        dup_ok.alias("duplicates_passed"),
        (~any_null).alias("nulls_passed"),
        null_text.alias("null_counts"),
    )
    out = out.withColumn("overall_passed", F.col("schema_passed") & F.col("types_passed")
                         & F.col("duplicates_passed") & F.col("nulls_passed"))
    if not ks:
        out = out.withColumn("duplicate_error", F.lit("Missing key columns for duplicate check"))
    if checked_at is not None:
        out = out.withColumn("checked_at", F.to_timestamp(F.lit(checked_at)))
    return out


def unavailable_report(spark, checked_at: str | None = None) -> DataFrame:
    """The report when the table cannot be loaded: every check false, no verdict."""
    row = [(False, "", "", False, "", None, None, None, False, False, "", None)]
    schema = ("schema_passed boolean, missing_columns string, extra_columns string, types_passed boolean, "
              "type_mismatches string, total_records long, unique_records long, duplicate_records long, "
              "duplicates_passed boolean, nulls_passed boolean, null_counts string, overall_passed boolean")
    out = spark.createDataFrame(row, schema)
    if checked_at is not None:
        out = out.withColumn("checked_at", F.to_timestamp(F.lit(checked_at)))
    return out


def audit_json(report: DataFrame) -> DataFrame:
    """The report as nested JSON text (one row, column ``report``)."""
    def split(c: str, sep: str = ",") -> Column:
        return F.when(col(c) == "", F.array().cast("array<string>")).otherwise(F.split(col(c), sep))

    nulls = F.when(F.col("null_counts") == "", F.create_map().cast("map<string,bigint>")).otherwise(
        F.transform_values(F.str_to_map(F.col("null_counts"), F.lit(","), F.lit("=")), lambda k, v: v.cast("bigint")))
    body = F.struct(
        F.struct(F.col("schema_passed").alias("passed"),
                 F.struct(split("missing_columns").alias("missing_columns"),
                          split("extra_columns").alias("extra_columns")).alias("details")
                 ).alias("schema_validation"),
        F.struct(F.col("types_passed").alias("passed"),
                 F.struct(F.transform(split("type_mismatches", ";"), lambda x: F.struct(
                     F.regexp_extract(x, r"^([^:]*):", 1).alias("column"),
                     F.regexp_extract(x, r":(.*)->", 1).alias("expected_type"),
                     F.regexp_extract(x, r"->(.*)$", 1).alias("actual_type"))).alias("type_mismatches")
                 ).alias("details")).alias("data_type_validation"),
        F.struct(F.col("duplicates_passed").alias("passed"),
                 F.struct("total_records", "unique_records", "duplicate_records",
                          *([F.col("duplicate_error").alias("error")]
                            if "duplicate_error" in report.columns else []),
                          *([F.col("sample_duplicates")]
                            if "sample_duplicates" in report.columns else [])).alias("details")
                 ).alias("duplicate_check"),
        F.struct(F.col("nulls_passed").alias("passed"),
                 F.struct(nulls.alias("null_counts")).alias("details")).alias("null_check"),
        F.col("overall_passed"),
        *([F.date_format("checked_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")]
          if "checked_at" in report.columns else []),
    )
    return report.select(F.to_json(body, {"pretty": "true"}).alias("report"))


def save_report(report: DataFrame, path: str, *, raise_errors: bool = False) -> bool:
    """Write the JSON report (a one-row text table) to ``path``.

    Like the reference, a failed write is logged and reported as ``False``
    rather than raised, unless ``raise_errors``.
    """
    try:
        audit_json(report).coalesce(1).write.mode("overwrite").text(path)
        return True
    except Exception:  # noqa: BLE001 - report sink errors are logged only
        if raise_errors:
            raise
        log.exception("could not save the audit report to %s", path)
        return False


def preview(df: DataFrame, n: int = 20, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a fixed order (default: all columns), so a preview repeats."""
    keys = order or df.columns
    return df.orderBy(*[col(c).asc_nulls_first() for c in keys]).limit(n)


def report_dict(report: DataFrame) -> dict:
    """The JSON report as a Python dict (one small row)."""
    return json.loads(audit_json(report).first()["report"])
