"""Quality gate: rule results per row, per file and per rule.

``gate(df, rules, file_col=...)`` binds the rules to the raw columns (rules
run before any cast, like the reference) and returns a :class:`GateResult`
whose DataFrames are all lazy:

* ``rows``        input columns + ``failed_rules array<string>``
* ``survivors()`` rows with no failed rule, from files that are not rejected
* ``quarantine()`` every other row: failed rules, or a rejected file
* ``verdicts()``  one row per file: accept / repair / reject
* ``rule_report()`` one row per (file, rule)

Plan shape: three scans, no full-row shuffle in the common case.

1. keys: one pass over the key columns counts 64-bit hashes of the
   ``(file, value)`` keys of all uniqueness rules and leaves a bit map;
2. facts: one pass over the rule columns counts rows by file, by the set of
   row-local rules they fail, and by key where the bit map says that it may
   repeat. Rows of unique keys collapse map-side into a few groups per file,
   so the table is small; repeated keys, per-file facts (rows, failing rows
   per rule, null ids), verdicts and the rule report all follow from it
   without another look at the rows;
3. rows: the repeated keys attached to the rows (see
   ``keys.attach_repeats``: a broadcast up to a checked size, else only rows
   that may repeat move), the facts as literals (one file) or a join that
   Spark broadcasts by the size of their table, and every rule as a Column
   expression in one projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import free_prefix
from ..session import materialize
from .keys import attach_repeats, marked_repeats
from .rules import Rule, RulePlan, plan_rules

ALL_FILES = "<all>"
NO_FILE = "<no file>"
MASK_BITS = 62


@dataclass
class GateResult:
    rows: DataFrame
    facts: DataFrame
    plans: list[RulePlan]
    file_col: str | None
    missing_required: list[str] = field(default_factory=list)
    _input_cols: list[str] = field(default_factory=list)
    helper: str = "_"          # start of the helper columns of ``rows``
    tally: DataFrame | None = None   # (_file, n, failing): rows of a file that fail, or not

    # -- row outputs -------------------------------------------------------
    def survives(self) -> Column:
        return (F.size("failed_rules") == 0) & F.col(self.helper + "file_ok")

    def survivors(self) -> DataFrame:
        return self.rows.where(self.survives()).select(*[F.col(f"`{c}`") for c in self._input_cols])

    def quarantine(self) -> DataFrame:
        """Every row that does not survive: rows with failed rules, and all rows of
        rejected files (their ``failed_rules`` may be empty; ``verdicts`` says why)."""
        return self.rows.where(~self.survives()).select(
            *[F.col(f"`{c}`") for c in self._input_cols], "failed_rules")

    def flagged(self) -> DataFrame:
        return self.rows.select(*[F.col(f"`{c}`") for c in self._input_cols], "failed_rules")

    # -- file outputs ------------------------------------------------------
    def verdicts(self) -> DataFrame:
        """accept: nothing failed; repair: failing rows dropped, survivors kept;
        reject: required column missing, every row failed, or a rule errored
        while no row failed."""
        if self.tally is None:   # rejected before any rule ran
            v = self.facts.select("_file", F.col("n_rows").alias("rows"), F.lit(0).cast("long").alias("failing_rows"),
                                  "rules_failed")
        else:
            v = self.tally.groupBy("_file").agg(
                F.sum("n").alias("rows"), F.sum(F.when(F.col("failing"), F.col("n")).otherwise(0)).alias("failing_rows"))
            v = v.join(self.facts.select("_file", "rules_failed"), "_file", "left")
        survivors = F.col("rows") - F.col("failing_rows")
        if self.missing_required:
            outcome = F.lit("reject")
            reason = F.lit("missing required columns: " + ",".join(sorted(self.missing_required)))
        else:
            outcome = (F.when((F.col("failing_rows") == 0) & (F.col("rules_failed") == 0), "accept")
                        .when(F.col("failing_rows") == 0, "reject")
                        .when(survivors == 0, "reject")
                        .otherwise("repair"))
            reason = (F.when((F.col("failing_rows") == 0) & (F.col("rules_failed") == 0), "all rules pass")
                       .when(F.col("failing_rows") == 0, "rule error")
                       .when(survivors == 0, "no survivors")
                       .otherwise("failing rows dropped"))
        return v.select(
            F.col("_file").alias("file"),
            "rows",
            "failing_rows",
            survivors.alias("survivors"),
            F.col("rules_failed").cast("long").alias("rules_failed"),
            outcome.alias("outcome"),
            reason.alias("reason"),
        )

    def rule_report(self) -> DataFrame:
        """One row per (file, rule): status pass | fail | skipped | error."""
        entries = []
        for i, p in enumerate(self.plans):
            r = p.rule
            if p.status == "active":
                status = F.when(F.col(f"s{i}"), "pass").otherwise("fail")
                flagged = F.col(f"u{i}")
                success = F.col(f"s{i}")
            else:
                status = F.lit(p.status)
                flagged = F.lit(0).cast("long")
                success = F.lit(p.status == "skipped")
            entries.append(F.struct(
                F.lit(r.position).alias("position"),
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.expectation_type).alias("expectation_type"),
                F.lit(r.column).cast("string").alias("column"),
                status.alias("status"),
                success.alias("success"),
                flagged.alias("unexpected_rows"),
                F.lit(p.reason).alias("reason"),
            ))
        if not entries:
            return self.facts.select(F.col("_file").alias("file")).where(F.lit(False))
        return self.facts.select(
            F.col("_file").alias("file"), F.inline(F.array(*entries)))


def _ok(fails: Column, denom: Column, mostly: float | None) -> Column:
    """Rule success for one file: nothing failing, or within ``mostly``."""
    if mostly is None:
        return fails == 0
    return (fails == 0) | ((denom - fails) / F.greatest(denom, F.lit(1)) >= F.lit(mostly))


def gate(df: DataFrame, rules: list[Rule], *, file_col: str | None = None,
         on_type_error: str = "cast", required: list[str] | None = None) -> GateResult:
    input_cols = list(df.columns)
    missing = [c for c in (required or []) if c not in input_cols]
    # a null file key still names one file, so none of its rows is orphaned
    h = free_prefix(input_cols)
    base = df.withColumn(h + "file", F.coalesce(F.col(f"`{file_col}`").cast("string"), F.lit(NO_FILE))
                         if file_col else F.lit(ALL_FILES))
    file = F.col(h + "file").alias("_file")
    plans = plan_rules(df.schema, rules, on_type_error)
    if missing:
        # Rejected before any rule runs: no rows survive, no rule is evaluated.
        facts = materialize(base.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
            "rules_failed", F.lit(0).cast("long")), "gate-facts")
        rows = base.withColumn("failed_rules", F.array().cast("array<string>")).withColumn(
            h + "file_ok", F.lit(False))
        skipped = [RulePlan(p.rule, "skipped", "file rejected: missing required columns") for p in plans]
        return GateResult(rows, facts, skipped, file_col, missing, input_cols, h)

    active = [(i, p) for i, p in enumerate(plans) if p.status == "active"]
    errors = [p for p in plans if p.status == "error"]

    # ---- keys that may repeat, rows counted by what they fail -----------------
    local = [(i, p) for i, p in active if p.fails is not None]
    unique = [(i, p) for i, p in active if p.fails is None]
    for i, p in unique:
        base = base.withColumn(f"{h}id{i}", p.value)
    counted = base
    if unique:
        counted = marked_repeats(base, {f"{h}hit{i}": [h + "file", f"{h}id{i}"] for i, _ in unique})
    by = [file]
    for m, lo in enumerate(range(0, len(local), MASK_BITS)):
        bits = [F.when(p.fails, F.lit(1 << b)).otherwise(F.lit(0)).cast("long")
                for b, (_, p) in enumerate(local[lo:lo + MASK_BITS])]
        by.append(sum(bits[1:], bits[0]).alias(f"m{m}"))
    for i, _ in unique:
        by.append(F.when(F.col(f"{h}hit{i}"), F.col(f"{h}id{i}")).alias(f"k{i}"))
        by.append(F.col(f"{h}id{i}").isNull().alias(f"null{i}"))
    nonnull = [F.count_if(F.col(f"`{p.rule.column}`").isNotNull()).alias(f"nn{i}")
               for i, p in local if p.rule.mostly is not None and p.rule.kind != "not_null"]
    groups = materialize(counted.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *nonnull), "gate-groups")
    fails = {i: F.col(f"m{j // MASK_BITS}").bitwiseAND(F.lit(1 << j % MASK_BITS)) != 0 for j, (i, _) in enumerate(local)}

    repeats = {}
    for i, _ in unique:
        rk = (groups.where(F.col(f"k{i}").isNotNull())
              .groupBy(F.col("_file").alias(h + "file"), F.col(f"k{i}").alias(f"{h}id{i}"))
              .agg(F.sum("n").alias("_n")).where(F.col("_n") > 1))
        repeats[i] = materialize(rk, "gate-repeats")

    # ---- per-file facts, from the groups alone ---------------------------------
    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    aggs = [F.sum("n").alias("n_rows")]
    for i, p in active:
        if p.fails is not None:
            aggs.append(rows_where(fails[i]).alias(f"f{i}"))
            if f"nn{i}" in groups.columns:
                aggs.append(F.sum(f"nn{i}").alias(f"nn{i}"))
        else:
            aggs += [rows_where(F.col(f"null{i}")).alias(f"z{i}"), rows_where(~F.col(f"null{i}")).alias(f"nn{i}")]
    facts = groups.groupBy("_file").agg(*aggs)
    for i, rk in repeats.items():
        # small: repeated keys only
        dup = rk.groupBy(file).agg(F.sum("_n").alias(f"f{i}"))
        facts = (facts.join(dup, "_file", "left")
                 .withColumn(f"f{i}", F.coalesce(F.col(f"f{i}"), F.lit(0))))

    derived = []
    for i, p in active:
        r = p.rule
        denom = F.col(f"nn{i}") if r.mostly is not None and r.kind != "not_null" else F.col("n_rows")
        ok = _ok(F.col(f"f{i}"), denom, r.mostly)
        derived.append(ok.alias(f"s{i}"))
        if p.fails is None:
            nullfail = (F.col(f"z{i}") >= 2) & ~ok
            derived.append(nullfail.alias(f"nf{i}"))
            derived.append((F.col(f"f{i}") + F.when(nullfail, F.col(f"z{i}")).otherwise(0)).alias(f"u{i}"))
        else:
            derived.append(F.col(f"f{i}").alias(f"u{i}"))
    n_fail_rules = [(~F.col(f"s{i}")).cast("int") for i, _ in active]
    rules_failed = sum(n_fail_rules, F.lit(len(errors)))
    any_rule_rows = F.lit(False)
    for i, _ in active:
        any_rule_rows = any_rule_rows | ~F.col(f"s{i}")
    facts = facts.select("*", *derived).select(
        "*", rules_failed.cast("long").alias("rules_failed"),
        # a file whose only problems are rule errors keeps no rows
        (any_rule_rows | F.lit(not errors)).alias("_file_ok"))
    facts = materialize(facts, "gate-facts")
    keep = ["_file_ok"] + [f"s{i}" for i, _ in active] + [f"nf{i}" for i in repeats]

    tally = groups.join(facts.select("_file", *keep), "_file", "left")
    failing = [fails[i] & ~F.col(f"s{i}") for i, _ in local]
    for i, rk in repeats.items():
        side = rk.select(F.col(h + "file").alias(f"r_file{i}"), F.col(f"{h}id{i}").alias(f"r_id{i}"))
        tally = tally.join(side, (F.col("_file") == F.col(f"r_file{i}")) & (F.col(f"k{i}") == F.col(f"r_id{i}")), "left")
        failing.append((F.col(f"r_id{i}").isNotNull() & ~F.col(f"s{i}")) | (F.col(f"null{i}") & F.col(f"nf{i}")))
    tally = tally.select("_file", "n", reduce(lambda a, b: a | b, failing, F.lit(False)).alias("failing"))

    # ---- row flags --------------------------------------------------------------
    flag = {k: h + k.removeprefix("_") for k in keep}
    rows = base
    for i, rk in repeats.items():
        rows = attach_repeats(rows, [h + "file", f"{h}id{i}"], rk, f"{h}k{i}", nulls_equal=False)
    if file_col is None:
        # one file: its facts are one row of flags, inlined as literals (no join)
        stats = facts.select(*keep).first()
        for k in keep:
            rows = rows.withColumn(flag[k], F.lit(bool(stats and stats[k])))
    else:
        small = facts.select(F.col("_file").alias(h + "file"), *[F.col(k).alias(flag[k]) for k in keep])
        rows = rows.join(small, h + "file", "left")
    tags = []
    for i, p in active:
        if p.fails is not None:
            bad = p.fails
        else:
            c = F.col(f"{h}id{i}")
            bad = (c.isNotNull() & (F.coalesce(F.col(f"{h}k{i}"), F.lit(1)) > 1)) | (c.isNull() & F.col(f"{h}nf{i}"))
        tags.append(F.when(bad & ~F.col(f"{h}s{i}"), F.lit(p.rule.rule_id)))
    if tags:
        failed = F.array_compact(F.array(*tags))
    else:
        failed = F.array().cast("array<string>")
    rows = rows.select(*[F.col(f"`{c}`") for c in input_cols], h + "file",
                       F.coalesce(F.col(h + "file_ok"), F.lit(False)).alias(h + "file_ok"),
                       failed.alias("failed_rules"))
    return GateResult(rows, facts, plans, file_col, [], input_cols, h, tally)
