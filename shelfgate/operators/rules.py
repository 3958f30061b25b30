"""Declarative quality rules: model, loading, and row predicates.

A rule file is the public extension point::

    {"expectations": [{"expectation_type": "...", "kwargs": {"column": ..., ...}}]}

Three rule types are understood; any other type is skipped (reported, never
fatal). Every rule becomes a Column expression; there is no Python UDF.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from ..functions.casts import as_double
from ..functions.predicates import is_missing, outside

# --- fixed values: rule type names of the rule file and our short kinds ---
EXPECTATION_KINDS = {
    "ExpectColumnValuesToNotBeNull": "not_null",
    "ExpectColumnValuesToBeUnique": "unique",
    "ExpectColumnValuesToBeBetween": "between",
}

# --- fixed values: the shipped rule set, in file order ---------------------
DEFAULT_RULE_CONFIG = {"expectations": [
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Run_Date"}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Retailer"}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Store_Info"}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Category_Traversal"}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Brand"}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Product_Name"}},
    {"expectation_type": "ExpectColumnValuesToBeUnique", "kwargs": {"column": "Product_ID"}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Variant_Info"}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "Size_Or_Quantity"}},
    {"expectation_type": "ExpectColumnValuesToBeBetween",
     "kwargs": {"column": "Original_Price", "min_value": 4, "max_value": 5760}},
    {"expectation_type": "ExpectColumnValuesToBeBetween",
     "kwargs": {"column": "Sale_Price", "min_value": 2.4, "max_value": 9644.4}},
    {"expectation_type": "ExpectColumnValuesToNotBeNull", "kwargs": {"column": "In_Stock"}},
]}

# --- fixed values: written data constraints of the exploration -------------
# Missing-rate ceilings (fraction of rows).
MISSING_RATE_LIMITS = {
    "Run_Date": 0.005, "Retailer": 0.005, "In_Stock": 0.005,
    "Brand": 0.01, "Product_Name": 0.01, "Size_Or_Quantity": 0.01,
    "Category_Traversal": 0.02, "Original_Price": 0.02, "Sale_Price": 0.02,
}
# JSON parse-success floors (fraction of non-null values).
JSON_RATE_FLOORS = {"Store_Info": 1.0, "Variant_Info": 0.95}
# Range tolerance applied to observed min/max: lo * 0.8, hi * 1.2.
RANGE_TOLERANCE = 0.2


@dataclass(frozen=True)
class Rule:
    expectation_type: str
    column: str | None
    min_value: float | None = None
    max_value: float | None = None
    mostly: float | None = None
    position: int = 0
    kwargs: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def kind(self) -> str:
        return EXPECTATION_KINDS.get(self.expectation_type, "unknown")

    @property
    def rule_id(self) -> str:
        return f"{self.kind}:{self.column}"


def parse_rules(config: dict) -> list[Rule]:
    """Rule list from a parsed rule file; a missing ``expectations`` key gives []."""
    out = []
    for i, e in enumerate(config.get("expectations", [])):
        kw = dict(e.get("kwargs", {}) or {})
        out.append(Rule(
            expectation_type=e.get("expectation_type", ""),
            column=kw.get("column"),
            min_value=_num(kw.get("min_value")),
            max_value=_num(kw.get("max_value")),
            mostly=_num(kw.get("mostly")),
            position=i + 1,
            kwargs=kw,
        ))
    return out


def _num(v):
    return None if v is None else float(v)


def load_rules(path: str) -> list[Rule]:
    """Read a rule file. Errors propagate (an ingest without rules must not run)."""
    with open(path) as fh:
        return parse_rules(json.load(fh))


def default_rules() -> list[Rule]:
    return parse_rules(DEFAULT_RULE_CONFIG)


_RULE_SCHEMA = StructType([
    StructField("position", IntegerType(), False),
    StructField("rule_id", StringType(), False),
    StructField("expectation_type", StringType(), True),
    StructField("kind", StringType(), False),
    StructField("column", StringType(), True),
    StructField("min_value", DoubleType(), True),
    StructField("max_value", DoubleType(), True),
    StructField("mostly", DoubleType(), True),
])


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rule set as a small DataFrame (control data, a dozen rows)."""
    rows = [(r.position, r.rule_id, r.expectation_type, r.kind, r.column,
             r.min_value, r.max_value, r.mostly) for r in rules]
    return spark.createDataFrame(rows, _RULE_SCHEMA)


def read_rules_json(spark: SparkSession, path: str) -> DataFrame:
    """Rule file read by Spark itself (any file system Spark reaches): one row per expectation."""
    kwargs = "column string, min_value string, max_value string, mostly string"
    raw = (spark.read.schema(f"expectations array<struct<expectation_type string, kwargs struct<{kwargs}>>>")
           .option("multiLine", True).json(path))
    rows = raw.select(F.posexplode("expectations").alias("pos", "e"))
    numbers = [F.col(f"e.kwargs.{n}").try_cast("double").alias(n) for n in ("min_value", "max_value", "mostly")]
    return rows.select((F.col("pos") + 1).alias("position"), F.col("e.expectation_type").alias("expectation_type"),
                       F.col("e.kwargs.column").alias("column"), *numbers)


def load_rules_spark(spark: SparkSession, path: str) -> list[Rule]:
    """:func:`load_rules` for a file on a cluster file system (S3, HDFS, ...).

    The rule file is control data (a dozen rows): it is read by Spark and
    the rows are brought to the driver to build the Column expressions.
    """
    out = []
    for r in read_rules_json(spark, path).orderBy("position").collect():
        kw = {k: r[k] for k in ("column", "min_value", "max_value", "mostly") if r[k] is not None}
        out.append(Rule(expectation_type=r["expectation_type"] or "", column=r["column"],
                        min_value=r["min_value"], max_value=r["max_value"], mostly=r["mostly"],
                        position=int(r["position"]), kwargs=kw))
    return out


# ---------------------------------------------------------------------------
# Planning: which rules apply to a given raw schema, and their predicates.

@dataclass
class RulePlan:
    rule: Rule
    status: str              # active | skipped | error
    reason: str = ""
    fails: Column | None = None      # row-local failure (not_null, between)
    value: Column | None = None      # the checked value (unique)


def plan_rules(schema: StructType, rules: list[Rule],
               on_type_error: str = "cast") -> list[RulePlan]:
    """Bind rules to a raw schema.

    * unknown rule type, or column absent from the data -> skipped;
    * no column named -> error (the rule cannot run);
    * range rule on a text column: ``cast`` parses it as a number first,
      ``error`` reproduces a failed rule with no failing rows.
    """
    names = {f.name: f.dataType for f in schema.fields}
    plans = []
    for r in rules:
        if r.kind == "unknown":
            plans.append(RulePlan(r, "skipped", "unsupported rule type"))
            continue
        if not r.column:
            plans.append(RulePlan(r, "error", "rule names no column"))
            continue
        if r.column not in names:
            plans.append(RulePlan(r, "skipped", "column not in data"))
            continue
        dtype = names[r.column]
        c = F.col(f"`{r.column}`")
        if r.kind == "not_null":
            plans.append(RulePlan(r, "active", fails=is_missing(c, dtype)))
        elif r.kind == "unique":
            # NaN is a missing id, as in the not-null rule
            floating = isinstance(dtype, (DoubleType, FloatType))
            plans.append(RulePlan(r, "active", value=F.when(~F.isnan(c), c) if floating else c))
        elif r.kind == "between":
            if isinstance(dtype, NumericType):
                v = as_double(c, dtype) if not isinstance(dtype, (DoubleType, FloatType)) else c
            elif isinstance(dtype, StringType) and on_type_error == "cast":
                v = as_double(c, dtype)
            else:
                plans.append(RulePlan(r, "error", f"cannot compare {dtype.simpleString()} with a number"))
                continue
            plans.append(RulePlan(r, "active", fails=outside(v, r.min_value, r.max_value)))
    return plans
