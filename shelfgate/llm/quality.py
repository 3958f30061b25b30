"""Quality rules: a decision list learned from labelled statistics.

``text_stats`` computes the statistics of every document with SQL functions.
``fit_rules`` grows and prunes threshold conjunctions by sequential covering
on a bounded sample of labelled rows, and ``DecisionList.expression`` gives
the ordered Spark conditional that applies them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import col

WS = r"[\\x20\\x09-\\x0D]+"
# The character classes that the statistics count.
_UPPER, _DIGIT, _SYMBOL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>"
_SPACE = r" \t\n\u000b\u000c\r"
WINDOW = 8
MAX_LABELLED = 20_000

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["n_words", "mean_word_chars", "symbol_ratio", "dup_line_ratio", "repeat_ratio",
            "upper_ratio", "digit_ratio", "distinct_ratio", "bang_ratio", "pipe_ratio"]

# Words of the windows found twice or more: the windows are sorted by hash, those with an equal
# neighbour are marked, and their positions (ascending) give the covered words.
_REPEATED = f"""
transform(array(sort_array(transform(_h8, (x, i) -> struct(x as h, i as p)))), s ->
  aggregate(
    sort_array(filter(transform(s, (e, i) ->
        if((i > 0 AND element_at(s, greatest(i, 1)).h = e.h)
           OR (i < size(s) - 1 AND element_at(s, least(i + 2, size(s))).h = e.h), e.p, -1)), p -> p >= 0)),
    struct(CAST(0 AS BIGINT) AS n, -{WINDOW} AS last),
    (a, p) -> struct(a.n + least({WINDOW}, p - a.last) AS n, p AS last),
    a -> a.n))[0]
"""


def text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` plus the columns of ``BASE`` and ``FEATURES``; null text counts as empty.

    Words are runs of anything but the six ASCII white-space characters.
    Windows of 8 words are compared by 64-bit hashes built by doubling
    (words, pairs, fours, eights). Columns of ``df`` with these names are
    replaced.
    """
    own = {*BASE, *FEATURES}
    cols = [c for c in df.columns if c not in own]
    t = F.coalesce(col(text_col), F.lit(""))
    # the given columns travel in one struct, so that none can have the name of a helper
    src = df.select(F.struct(F.lit(0).alias("_"), *[col(c).alias(f"c{i}") for i, c in enumerate(cols)]).alias("row"),
                    t.alias("_t"))
    src = src.select("*", F.expr(r"btrim(_t, ' \t\n\u000b\u000c\r')").alias("_b"))
    src = src.select("*", F.expr(f"if(_b = '', CAST(array() AS array<string>), split(_b, '{WS}', -1))").alias("_w"),
                     F.expr(r"filter(split(_t, '\n', -1), l -> btrim(l, ' \t\n\u000b\u000c\r') <> '')").alias("_l"))
    src = src.select("*", F.size("_w").alias("_n"), F.expr("transform(_w, w -> xxhash64(w))").alias("_h1"))
    for name, of, step in (("_h2", "_h1", 1), ("_h4", "_h2", 2), ("_h8", "_h4", 4)):
        left = f"_n - {2 * step - 1}"
        src = src.select("*", F.expr(
            f"if(_n >= {WINDOW}, zip_with(slice({of}, 1, {left}), slice({of}, {step + 1}, {left}), "
            f"(a, b) -> xxhash64(a, b)), CAST(array() AS array<bigint>))").alias(name))
    src = src.select("*", F.expr(
        f"CASE WHEN size(array_distinct(_h8)) = size(_h8) THEN CAST(0 AS BIGINT) ELSE {_REPEATED} END")
        .alias("_rep"))
    # one pass maps each class of characters to one character; counting that one is cheap
    src = src.select("*", F.expr(f"translate(_t, '{_UPPER}{_DIGIT}{_SYMBOL}{_SPACE}', "
                                 f"'{'A' * 26}{'0' * 10}{'#' * 8}{' ' * 6}')").alias("_c"), F.length("_t").alias("_len"))

    def count(of: str, char: str) -> Column:
        return (F.col("_len") - F.length(F.replace(F.col(of), F.lit(char), F.lit("")))).cast("long")

    def per(top: Column, by: Column) -> Column:
        return top.cast("double") / F.greatest(by, F.lit(1))

    src = src.select("*", F.col("_n").cast("long").alias("_words"), (F.col("_len") - count("_c", " ")).alias("_chars"),
                     count("_c", "#").alias("_sym"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("_dl"))
    words, chars = F.col("_words"), F.col("_chars")
    stats = {"n_words": words, "word_chars": chars, "n_symbols": F.col("_sym"), "n_dup_lines": F.col("_dl"),
             "n_repeat_words": F.col("_rep"), "mean_word_chars": per(chars, words), "symbol_ratio": per(F.col("_sym"), chars),
             "dup_line_ratio": per(F.col("_dl"), F.size("_l")), "repeat_ratio": per(F.col("_rep"), words),
             "upper_ratio": per(count("_c", "A"), chars), "digit_ratio": per(count("_c", "0"), chars),
             "distinct_ratio": per(F.size(F.array_distinct("_h1")), words),
             "bang_ratio": per(count("_t", "!"), chars), "pipe_ratio": per(count("_t", "|"), chars)}
    # a generator, so that a filter on the statistics is not pushed down and computed a second time
    return src.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(cols)], F.inline(F.array(F.struct(*[c.alias(k) for k, c in stats.items()]))))


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v >= self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)


@dataclass
class DecisionList:
    """Ordered rejection rules; a document that no rule covers is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rejects(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        for rule in self.rules:
            out |= _covers(rule, x)
        return out

    def expression(self) -> Column:
        """``kept`` as one CASE expression over the columns of :func:`text_stats`."""
        out = None
        for rule in self.rules:
            cond = rule[0].column()
            for c in rule[1:]:
                cond = cond & c.column()
            out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))


def _covers(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for c in rule:
        hit &= c.holds(x)
    return hit


def _grow(x: np.ndarray, y: np.ndarray, max_conditions: int, bins: int) -> list[Condition]:
    """Add the condition with the largest information gain until no good row is covered."""
    rule: list[Condition] = []
    hit = np.ones(len(x), bool)
    while len(rule) < max_conditions:
        p0, n0 = int(y[hit].sum()), int((~y[hit]).sum())
        if p0 == 0 or n0 == 0:
            break
        base, best, best_gain = np.log2(p0 / (p0 + n0)), None, 1e-9
        for k, name in enumerate(FEATURES):
            values = x[hit, k]
            for th in np.unique(np.quantile(values, np.linspace(0, 1, bins + 1), method="nearest")):
                for above in (True, False):
                    c = values >= th if above else values <= th
                    p = int((c & y[hit]).sum())
                    if p == 0:
                        continue
                    gain = p * (np.log2(p / int(c.sum())) - base)
                    if gain > best_gain:
                        best, best_gain = Condition(name, above, float(th)), gain
        if best is None:
            break
        rule.append(best)
        hit &= best.holds(x)
    return rule


def _prune(rule: list[Condition], x: np.ndarray, y: np.ndarray) -> list[Condition]:
    """The prefix of the rule with the best (p - n) / (p + n) on the pruning rows."""
    def worth(r: list[Condition]) -> float:
        hit = _covers(r, x)
        p, n = int((hit & y).sum()), int((hit & ~y).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=[])


def learn(x: np.ndarray, y: np.ndarray, *, min_precision: float = 0.95, min_support: int = 5,
          max_rules: int = 12, max_conditions: int = 4, bins: int = 32) -> DecisionList:
    """Sequential covering. ``y`` is True where a row is to be rejected.

    Every third row is held for pruning; a rule enters the list only if it
    covers ``min_support`` pruning rows with ``min_precision``.
    """
    held = np.arange(len(x)) % 3 == 2
    gx, gy, px, py = x[~held], y[~held], x[held], y[held]
    found = DecisionList()
    while len(found.rules) < max_rules and gy.any():
        rule = _grow(gx, gy, max_conditions, bins)
        rule = _prune(rule, px, py) if rule else rule
        if not rule:
            break
        hit = _covers(rule, px)
        p, n = int((hit & py).sum()), int((hit & ~py).sum())
        if p < min_support or p / (p + n) < min_precision:
            break
        found.rules.append(rule)
        gone = _covers(rule, gx)
        gx, gy = gx[~gone], gy[~gone]
        px, py = px[~hit], py[~hit]
    return found


def fit_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", max_labelled: int = MAX_LABELLED, **kw) -> DecisionList:
    """Learn from at most ``max_labelled`` labelled rows (``label_col`` 0: reject).

    The rows are those with the smallest hashes of the id, so the sample does
    not depend on partitioning. Only their statistics reach the driver.
    Labels without id or value are ignored, repeated ones count by their
    largest value; without labels the list is empty and keeps everything.
    """
    lab = (labels.select(F.col(f"`{id_col}`").alias("_lid"), F.col(f"`{label_col}`").alias("_y"))
           .where("_lid IS NOT NULL AND _y IS NOT NULL").groupBy("_lid").agg(F.max("_y").alias("_y"))
           .orderBy(F.xxhash64("_lid"), "_lid").limit(max_labelled))
    picked = (docs.select(F.col(f"`{id_col}`").alias("_lid"), F.col(f"`{text_col}`").alias("_text"))
              .join(F.broadcast(lab), "_lid"))
    rows = (text_stats(picked, "_text").where(~base_failed()).select("_lid", "_y", *FEATURES)
            .orderBy(F.xxhash64("_lid"), "_lid", "n_words").limit(2 * max_labelled).collect())
    if not rows:
        return DecisionList()
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows])
    return learn(x, np.array([r["_y"] == 0 for r in rows]), **kw)


def apply_rules(docs: DataFrame, rules: DecisionList, *, text_col: str = "text") -> DataFrame:
    """``docs`` plus statistics, ``base_failed`` and ``kept`` (false if the base rules
    fail, else the list's verdict). Null and empty texts fail the base rules."""
    out = text_stats(docs.drop("base_failed", "kept"), text_col).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & rules.expression())


def keep_good(docs: DataFrame, rules: DecisionList, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`apply_rules` keeps, with their own columns alone, whatever their names."""
    packed = docs.select(F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("doc"),
                         col(text_col).alias("text"))
    return (apply_rules(packed, rules).where("kept")
            .select(*[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(docs.columns)]))
