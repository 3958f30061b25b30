"""Ingest: latest file per source -> schema groups -> gate -> conform -> union -> sink.

Two entry points share one core:

* :func:`ingest_frame` / :func:`ingest_latest_frame` work on a DataFrame
  that already carries a file column (any scan, or a derived view);
* :func:`run_ingest` starts from a landing folder: it lists it, picks the
  newest file per source as of a date, reads the footers of all parts, gates
  every file, and appends (or publishes) the conformed survivors.

``run_ingest`` evaluates the rules on the rows once: the row pass of each
schema group is written to the shared folder, partitioned by outcome and
file, and survivors and quarantine are read back from their partitions. With
the gate's two passes that makes three scans of the chosen files. Whatever
cannot be read shows there, before anything reaches a sink.

Per-file decisions (verdicts) are DataFrames, not driver loops; the driver
only sees the names of the chosen files (at most one per source) to open
the scans.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.schema import CANONICAL, SOURCE_FILE, col, free_prefix, required_names
from ..operators.catalog import latest_as_of
from ..operators.conform import conform_types
from ..operators.gate import GateResult, gate
from ..operators.rules import Rule
from ..operators.schema_checks import new_column_log, schema_missing
from ..session import materialize, scratch_path
from ..sources import publish
from ..sources.catalog import entry_files, parse_names, read_catalog
from ..sources.listing import (
    Group,
    damaged_files,
    file_schemas,
    part_schemas,
    plan_scans,
    readable,
    rejected,
    scan,
    with_spark_fallback,
)
from ..sources.sinks import append_column_log, write_unified


log = logging.getLogger("shelfgate.ingest")


@dataclass
class IngestOutcome:
    unified: DataFrame | None   # conformed survivors of accepted/repaired files
    verdicts: DataFrame         # one row per file
    gates: list[GateResult]
    staged: list[Staged] | None = None   # the rows as run_ingest evaluated them

    def rule_report(self) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b), [g.rule_report() for g in self.gates])

    def quarantine(self) -> DataFrame | None:
        """Rows that did not survive, raw values as text, with ``failed_rules``.

        Text keeps what the file held (``"$12.00"``) and lets schema groups
        with different raw types union by name.
        """
        parts = []
        for q in [x.quarantine() for x in (self.staged or self.gates)]:
            parts.append(q.select(*[col(c).cast("string").alias(c) for c in q.columns
                                    if c != "failed_rules"], "failed_rules"))
        if not parts:
            return None
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@dataclass
class Staged:
    """The evaluated rows of one schema group, written once by outcome and file."""

    frame: DataFrame            # the staging table
    columns: list[str]
    outcome: str                # names of the partition columns
    file: str
    failed: str

    def survivors(self) -> DataFrame:
        rows = self.frame.where(F.col(self.outcome) == "survivor")
        return rows.select(*[self._column(c) for c in self.columns])

    def quarantine(self) -> DataFrame:
        rows = self.frame.where(F.col(self.outcome) != "survivor")
        return rows.select(*[self._column(c) for c in self.columns], F.col(self.failed).alias("failed_rules"))

    def _column(self, name: str):
        return F.col(self.file).alias(name) if name == SOURCE_FILE else col(name)


def stage(g: GateResult) -> Staged:
    """Evaluate the rows of a gate once: one write, read back by partition.

    Outcomes: ``survivor``, ``failed`` (a rule failed), ``held`` (none did, but the file is rejected).
    """
    columns = g.survivors().columns
    p = free_prefix([*columns, *g.rows.columns])
    failing = F.size("failed_rules") > 0
    outcome = F.when(g.survives(), "survivor").when(failing, "failed").otherwise("held")
    rows = g.rows.select(*[col(c) for c in columns if c != SOURCE_FILE], F.col("failed_rules").alias(p + "failed"),
                         outcome.alias(p + "outcome"), F.col(SOURCE_FILE).alias(p + "file"))
    path = scratch_path(rows.sparkSession, "ingest-rows")
    rows.write.partitionBy(p + "outcome", p + "file").parquet(path)
    schema = StructType([f for f in rows.schema.fields if f.name not in (p + "outcome", p + "file")]
                        + [StructField(p + n, StringType()) for n in ("outcome", "file")])
    return Staged(rows.sparkSession.read.schema(schema).parquet(path), columns, p + "outcome", p + "file", p + "failed")


def ingest_frame(df: DataFrame, rules: list[Rule], *, file_col: str = SOURCE_FILE,
                 schema: StructType = CANONICAL, on_type_error: str = "cast",
                 keep_source: bool = False) -> IngestOutcome:
    """Gate every file of ``df`` on its raw columns, then conform the survivors."""
    g = gate(df, rules, file_col=file_col, on_type_error=on_type_error,
             required=required_names(schema))
    keep = [file_col] if keep_source else None
    unified = conform_types(g.survivors(), schema, fill_missing=True, keep=keep)
    return IngestOutcome(unified, g.verdicts(), [g])


def ingest_latest_frame(df: DataFrame, rules: list[Rule], *, sources: list[str], reference_date,
                        file_col: str = SOURCE_FILE, **kw) -> IngestOutcome:
    """Keep only the newest file per source on or before ``reference_date``, then ingest.

    The chosen-file list has at most one row per source: it is computed once
    (written to the shared folder, so the gate's passes do not recompute it)
    and broadcast.
    """
    names = df.select(F.col(file_col).alias("path")).distinct()
    latest = materialize(latest_as_of(parse_names(names, sources), reference_date).select(
        F.col("file_name").alias("_chosen")), "latest-files")
    chosen = df.join(F.broadcast(latest), F.col(file_col) == F.col("_chosen"), "left_semi")
    return ingest_frame(chosen, rules, file_col=file_col, **kw)


@dataclass
class IngestResult:
    ok: bool
    reason: str
    outcome: IngestOutcome | None = None
    files: list[str] | None = None


@dataclass
class Landing:
    """What a landing folder holds for a run: the scans to open and the files that cannot be scanned."""

    schemas: DataFrame          # (file_name, ordinal, column, type) of the files that can
    groups: list[Group]
    rejected: list[tuple[str, str]]   # (file, error)
    entries: DataFrame          # (entry, bytes, digest)

    @property
    def files(self) -> list[str]:
        return sorted([f for g in self.groups for f in g.files] + [f for f, _ in self.rejected])


def read_landing(spark: SparkSession, input_dir: str, chosen: DataFrame) -> Landing:
    """Schemas, scans and digests of the ``chosen`` entries (``path``, ``file_name``), from their footers."""
    files = materialize(entry_files(spark, input_dir, chosen), "landing-files")
    parts = with_spark_fallback(spark, materialize(part_schemas(files), "part-schemas"), files)
    schemas = materialize(file_schemas(parts), "file-schemas")
    # contents as the footers tell them, whatever the parts are called; sizes where only Spark can read
    digest = (parts.groupBy("file_name", "leaf").agg(F.max("digest").alias("d"))
              .groupBy("file_name").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ","), 256).alias("digest")))
    sizes = files.groupBy("file_name").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    entries = (sizes.join(digest, "file_name", "left")
               .select(F.col("file_name").alias("entry"), "bytes",
                       F.sha2(F.concat_ws(":", F.col("bytes").cast("string"), F.col("n").cast("string"),
                                          "digest"), 256).alias("digest")))
    bad = [(r["file_name"], r["error"]) for r in rejected(schemas).collect()]
    return Landing(readable(schemas), plan_scans(parts, schemas, files), bad, entries)


def run_ingest(spark: SparkSession, input_dir: str, output_path: str, rules: list[Rule], *,
               reference_date, sources: list[str] | None = None, schema: StructType = CANONICAL,
               column_log_path: str | None = None, detection_time: str | None = None,
               on_type_error: str = "cast", partition_by: list[str] | None = None,
               overwrite_partitions: bool = False, quarantine_path: str | None = None,
               once: bool = False) -> IngestResult:
    """End-to-end ingest of one landing folder (the reference's ``run_pipeline``).

    Takes the newest file per source (``sources``, matched by the name format)
    dated on or before ``reference_date``, gates every chosen file on its raw
    columns, and appends the conformed survivors to ``output_path``.
    ``column_log_path`` + ``detection_time`` log columns outside the schema;
    ``quarantine_path`` keeps the rows that did not survive; ``partition_by``
    + ``overwrite_partitions`` make a rerun replace its partitions.

    ``once`` publishes instead of appending (see ``sources.publish``): files
    whose contents the table holds already are left out, and survivors,
    quarantine and column log become visible together when their batch is
    committed. Read them with ``read_unified`` and ``publish.read_published``.

    Returns ``IngestResult(ok, reason, outcome, files)``: ``ok`` is False when
    no file is found or none survives (nothing is written then; with ``once``
    the files count as seen, and their quarantine is kept);
    ``outcome.verdicts`` has one row per chosen file.
    """
    if once and (partition_by or overwrite_partitions):
        raise ValueError("a published table has its own partitions")
    catalog = read_catalog(spark, input_dir, sources)
    latest = latest_as_of(catalog, reference_date)
    chosen = catalog.join(F.broadcast(latest.select("path")), "path", "left_semi")
    landing = read_landing(spark, input_dir, chosen)
    if not landing.files:
        log.warning("no files found in %s on or before %s", input_dir, reference_date)
        return IngestResult(False, "no files found")
    fresh = None
    if once:
        fresh = materialize(publish.unpublished(landing.entries, publish.read_manifest(spark, output_path)),
                            "new-entries")
        new = {r["entry"] for r in fresh.select("entry").collect()}   # at most one file per source
        known = [f for f in landing.files if f not in new]
        if not new:
            log.info("every chosen file is published already: %s", known)
            return IngestResult(True, "already published", None, [])
        groups = [g.without(set(known), spark, input_dir) for g in landing.groups]
        landing = Landing(landing.schemas.where(F.col("file_name").isin(list(new))), [g for g in groups if g],
                          [x for x in landing.rejected if x[0] in new], fresh)
    log.info("chosen files: %s", landing.files)

    outcomes, errored = [], []

    def gated(group: Group) -> IngestOutcome:
        df = scan(spark, input_dir, group)
        found = ingest_frame(df, rules, file_col=SOURCE_FILE, schema=schema, on_type_error=on_type_error)
        staged = [stage(g) for g in found.gates]
        parts = [conform_types(x.survivors(), schema, fill_missing=True, keep=[SOURCE_FILE]) for x in staged]
        return IngestOutcome(reduce(lambda a, b: a.unionByName(b), parts), found.verdicts, found.gates, staged)

    for group in landing.groups:
        bad = list(group.files)
        try:
            try:
                outcomes.append(gated(group))
                continue
            except Exception:  # noqa: BLE001 - the files that can be read are gated without the others
                damaged = damaged_files(spark, input_dir, group)
                rest = group.without(set(damaged), spark, input_dir) if damaged else None
                if rest:
                    outcomes.append(gated(rest))
                    bad = damaged
                raise
        except Exception as exc:  # noqa: BLE001 - like the reference, an error rejects the file, not the run
            log.error("files %s rejected: %s", bad, exc)
            errored += [(f, f"error: {type(exc).__name__}: {exc}") for f in bad]
    verdict_parts = [o.verdicts for o in outcomes]
    if failures := landing.rejected + errored:
        verdict_parts.append(spark.createDataFrame(
            [(f, 0, 0, 0, 0, "reject", why) for f, why in failures],
            "file string, rows long, failing_rows long, survivors long, rules_failed long, "
            "outcome string, reason string"))
    # one row per file, computed once: it decides the write and is returned
    verdicts = materialize(reduce(lambda a, b: a.unionByName(b), verdict_parts), "verdicts")
    named = reduce(lambda a, b: a.unionByName(b), [o.unified for o in outcomes]) if outcomes else None
    outcome = IngestOutcome(named.drop(SOURCE_FILE) if outcomes else None, verdicts,
                            [g for o in outcomes for g in o.gates], [x for o in outcomes for x in o.staged])
    tally = {r["outcome"]: r["files"] for r in
             verdicts.groupBy("outcome").agg(F.count(F.lit(1)).alias("files")).collect()}
    log.info("file verdicts: %s", tally)
    survived = sum(n for k, n in tally.items() if k != "reject") > 0

    # like the reference, only files that pass the required-column check log new columns
    lacking = schema_missing(landing.schemas, required_names(schema)).select("file_name")
    logged = new_column_log(landing.schemas.join(lacking, "file_name", "left_anti"), detection_time,
                            schema) if column_log_path and detection_time else None
    if once:
        batch = publish.batch_id(fresh)
        if survived:
            publish.stage(named, output_path, batch, SOURCE_FILE)
        if quarantine_path and outcomes:
            publish.stage(outcome.quarantine(), quarantine_path, batch, SOURCE_FILE)
        if logged is not None:
            publish.stage(logged.withColumn(SOURCE_FILE, F.col("file_name")), column_log_path, batch, SOURCE_FILE)
        # a file that an error kept out is tried again by the next run
        done = fresh.where(~F.col("entry").isin([f for f, _ in errored])) if errored else fresh
        publish.commit(spark, output_path, batch, done)
        log.info("published batch %s in %s", batch, output_path)
    else:
        if logged is not None:
            append_column_log(logged, column_log_path)
        if survived:
            write_unified(outcome.unified, output_path, partition_by=partition_by,
                          overwrite_partitions=overwrite_partitions)
            log.info("appended survivors to %s", output_path)
            if quarantine_path:
                # the reference discards these rows; kept here for whoever fixes the source
                outcome.quarantine().write.mode("append").parquet(quarantine_path)
    if not survived:
        log.error("no file survived the gate")
        return IngestResult(False, "no file survived the gate", outcome, landing.files)
    return IngestResult(True, "ok", outcome, landing.files)
