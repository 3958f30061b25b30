"""Secret scan of every version of every path, with a ledger of what has been scanned.

A version is addressed by the SHA-256 of its text, its blob. The ledger, a
Parquet table that outlives a run, holds for each blob the rules it has been
scanned by, each in a version (``name@version``), and what they found. A run
scans only the pairs of blob and rule version the ledger does not have: new
texts by all rules, known texts by new rules, copies once. It appends them in
one write, which shows whole or not at all, and joins findings back to all
paths by their blob. Running twice scans nothing the second time.

Texts cross the network only where they must: two bit maps of fixed size
over the blobs tell which texts need no scan, which are new and without a
copy, so that they are scanned where they are, and which may repeat or be
partly known; only those meet by blob, combined before the shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, path_exists
from .bitmap import BITS, bit_map, marked

HOT_ROWS = 10_000
MAX_HOT = 100_000
LEDGER = "blob binary, rules array<string>, found array<struct<rule:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """One kind of secret: a Python pattern (ASCII classes) whose leftmost non-overlapping matches count
    if ``group`` has ``least`` characters. Texts without any of ``probes`` (in small letters) are not
    searched. Raise ``version`` with every change: known texts are then scanned again by this rule."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    probes: tuple[str, ...] = ()
    version: int = 1
    ignore_case: bool = False

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         ("passw", "secret", "token", "api"), ignore_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, ("akia",)),
    Rule("hex", r"[0-9a-f]{16,}"),  # the runs of 16 and more
)
# Tokens with a public, fixed form of their own.
RULES = (
    *BASE,
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----", probes=("private key-----",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", probes=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", probes=("xox",)),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", probes=("aiza",)),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", probes=("k_live_",)),
)


def find(text: str, rules: list[Rule], compiled: dict[Rule, re.Pattern] | None = None) -> list[dict]:
    """Spans of one text in code points, end exclusive, by start, then rule as listed."""
    compiled = compiled or {r: _pattern(r) for r in rules}
    low, found = text.lower(), []
    for k, rule in enumerate(rules):
        if not rule.probes or any(p in low for p in rule.probes):
            found += [(m.start(), k, m.end()) for m in compiled[rule].finditer(text)
                      if m.end(rule.group) - m.start(rule.group) >= rule.least]
    return [{"rule": rules[k].key, "start": a, "end": b} for a, k, b in sorted(found)]


def _pattern(rule: Rule) -> re.Pattern:
    return re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.ignore_case else 0))


def _scan(rules: tuple[Rule, ...]):
    found_type = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        compiled = {r: _pattern(r) for r in rules}
        for batch in batches:
            wanted = batch.column("rules").to_pylist()
            found = [find(t, [r for r in rules if r.key in w], compiled)
                     for t, w in zip(batch.column("text").to_pylist(), wanted)]
            yield pa.RecordBatch.from_arrays([batch.column("blob"), batch.column("rules"), pa.array(found, found_type)],
                                             names=["blob", "rules", "found"])
    return run


def read_ledger(spark, ledger: str) -> DataFrame:
    """Rows of the ledger, none if there is no such table yet."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def _versions(docs: DataFrame, text_col: str, *more) -> DataFrame:
    src = docs.select(*more, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return src.withColumn("blob", F.unhex(F.sha2("text", 256)))


def update_ledger(docs: DataFrame, paths: DataFrame, ledger: str, rules: tuple[Rule, ...], text_col: str,
                  bits: int = BITS) -> None:
    """Scan the pairs of blob and rule version that ``ledger`` lacks and append them to it."""
    spark = docs.sparkSession
    active = F.array(*[F.lit(r.key) for r in rules])
    seen = (read_ledger(spark, ledger).select("blob", F.explode("rules").alias("rule")).groupBy("blob")
            .agg(F.collect_set("rule").alias("seen")).withColumnRenamed("blob", "s_blob"))
    blobs = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("n"))
    blobs = (blobs.join(seen, F.col("blob") == F.col("s_blob"), "left")
             .select("blob", F.xxhash64("blob").alias("h"), ((F.col("n") == 1) & F.col("seen").isNull()).alias("fresh"),
                     F.when(F.col("seen").isNull(), active).otherwise(F.array_except(active, "seen")).alias("rules")))
    todo = materialize(blobs.where((F.size("rules") > 0) | ~F.col("fresh")), "secret-todo")
    texts = _versions(docs, text_col).withColumn("h", F.xxhash64("blob"))
    texts = marked(texts, "h", bit_map(todo.where("size(rules) > 0"), "h", "open", bits), "open", bits).where("open")
    texts = marked(texts, "h", bit_map(todo.where("NOT fresh"), "h", "shared", bits), "shared", bits)
    alone = texts.where("NOT shared").select("blob", "text", active.alias("rules"))
    once = texts.where("shared").groupBy("blob").agg(F.first("text").alias("text"))
    asked = todo.where("size(rules) > 0").select(F.col("blob").alias("t_blob"), "rules")
    shared = once.join(asked, F.col("blob") == F.col("t_blob")).select("blob", "text", "rules")
    alone.unionAll(shared).mapInArrow(_scan(rules), LEDGER).write.mode("append").parquet(ledger)


def scan(docs: DataFrame, ledger: str, *, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES, hot_rows: int = HOT_ROWS, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``blob`` (hex) and ``spans``, an array of (rule, k, start, end).

    A row is one version of one path; history is more rows with the same id.
    ``ledger`` is the folder of the ledger, kept between runs and made when
    it is not there. Spans are in code points, end exclusive, ordered by
    start, then rule as listed (``k``). Null texts count as empty; null and
    repeated ids, and repeated rows, each keep their row. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    if len({r.key for r in rules}) < len(rules):
        raise ValueError("two rules share a name and version")
    paths = materialize(_versions(docs, text_col, F.col(f"`{id_col}`").alias("id")).select("id", "blob"), "secret-paths")
    update_ledger(docs, paths, ledger, rules, text_col, bits)
    number = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.key), F.lit(k))])
    spans = F.transform("s", lambda x: F.struct(x["start"].alias("start"), F.element_at(number, x["rule"]).alias("k"),
                                                x["end"].alias("end")))
    # what versions of a rule that are not asked for found stays in the ledger
    found = (read_ledger(docs.sparkSession, ledger).select("blob", F.explode("found").alias("x"))
             .where(F.col("x.rule").isin([r.key for r in rules])).groupBy("blob")
             .agg(F.collect_set("x").alias("s")).select(F.col("blob").alias("f_blob"), F.sort_array(spans).alias("s")))
    found = materialize(found, "secret-found")

    # a text that very many paths share: its few rows of findings are repeated, its paths salted
    total = paths.count()
    limit = max(hot_rows, -(-total // MAX_HOT))
    counts = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    hot = materialize(counts.select(F.col("blob").alias("h_blob"),
                                    F.ceil(F.col("n") / F.lit(limit)).cast("int").alias("salts")), "secret-hot")
    salted = (paths.join(F.broadcast(hot), F.col("blob") == F.col("h_blob"), "left")
              .select("id", "blob", F.floor(F.rand(7) * F.coalesce("salts", F.lit(1))).cast("int").alias("salt")))
    found = (found.join(F.broadcast(hot), F.col("f_blob") == F.col("h_blob"), "left")
             .select("f_blob", "s", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("f_salt")))
    rows = salted.join(found, (F.col("blob") == F.col("f_blob")) & (F.col("salt") == F.col("f_salt")), "left")
    names = F.array(*[F.lit(r.name) for r in rules])
    spans = F.transform(F.coalesce("s", F.array().cast("array<struct<start:bigint,k:int,end:bigint>>")),
                        lambda x: F.struct(F.element_at(names, x["k"] + 1).alias("rule"), x["k"].alias("k"),
                                           x["start"].alias("start"), x["end"].alias("end")))
    return rows.select(F.col("id").alias(id_col), F.lower(F.hex("blob")).alias("blob"), spans.alias("spans"))
