"""Exact dedup by content sort (DataFrame functions only).

Sampled splitters range-partition the texts (``repartitionByRange`` samples
its own splitters), the external sort below the window places equal texts
next to each other, and the window compares neighbouring texts in full to
find where a group starts and ends. One row of each group stays. Texts are
ordered by their first ``PREFIX`` characters, then by a hash, then in full:
the splitters, which Spark samples through the driver, stay short however
long the texts are, and texts with one common beginning spread over ranges.

Skew and memory: all rows of one text would meet in one range, and the
window holds up to 4,096 rows of a group in memory, each with its text.
Texts that occur more than ``max(HOT_ROWS, rows / MAX_HOT)`` times, or whose
copies have more than ``max(HOT_BYTES, bytes / MAX_HOT)`` bytes together, are
found by a count over 64-bit hashes (combined map-side, at most ``MAX_HOT``
by either bound, so they may be broadcast). Their rows get a salt that is
part of the sort key, of as many values as keep the mean sub-group within
both bounds (``SALTS`` at least); the sub-groups are merged afterwards from
one row each. The salt follows from the id: rows that repeat one id and one
text stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

PREFIX = 64
HOT_ROWS = 1000
HOT_BYTES = 16 << 20
MAX_HOT = 100_000
SALTS = 64


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest", hot_rows: int = HOT_ROWS, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are identical; null counts as empty.
    The row with the largest (or ``keep="smallest"``) id stays; null ids lose
    against others, and ``keep_id`` is null where a group has no id. Of
    repeated rows (same id, same text) one is kept. Other columns of ``docs``
    are ignored, whatever their names. An empty table gives an empty result.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be 'largest' or 'smallest', not {keep!r}")
    src = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_t"))
    src = src.select("_id", "_t", F.left("_t", F.lit(PREFIX)).alias("_p"), F.xxhash64("_t").alias("_h"))
    n, size = F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("_t").cast("long")).alias("_b")
    total = src.agg(n, size).first()
    most_rows = max(hot_rows, -(-total["_n"] // MAX_HOT))
    most_bytes = max(hot_bytes, -(-(total["_b"] or 0) // MAX_HOT))
    hot = None
    if total["_n"] > most_rows or (total["_b"] or 0) > most_bytes:
        salts = F.greatest(F.lit(SALTS), F.ceil(F.col("_n") / most_rows), F.ceil(F.col("_b") / most_bytes))
        hot = materialize(src.groupBy("_h").agg(n, size)
                          .where((F.col("_n") > 1) & ((F.col("_n") > most_rows) | (F.col("_b") > most_bytes)))
                          .select(F.col("_h").alias("_hot"), salts.cast("int").alias("_salts")), "exact-hot")
        hot = hot if hot.take(1) else None
    keys = ["_p", "_h"]
    if hot is not None:
        src = src.join(F.broadcast(hot), F.col("_h") == F.col("_hot"), "left")
        salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64("_id"), F.col("_salts")) + 1).otherwise(0)
        src = src.select("_id", "_t", "_p", "_h", salt.cast("int").alias("_s"))
        keys = [*keys, "_s"]

    best = F.max if keep == "largest" else F.min
    order = F.desc_nulls_last("_id") if keep == "largest" else F.asc_nulls_last("_id")
    group = Window.partitionBy(*keys, "_t")
    rows = (src.repartitionByRange(*keys)
            .select("_id", *keys[2:], F.sha2("_t", 256).alias("_sha"),
                    F.row_number().over(group.orderBy(order)).alias("_rn"),
                    F.count(F.lit(1)).over(group).alias("_gn"),
                    best("_id").over(group).alias("_gk")))
    if hot is None:
        return rows.select(F.col("_id").alias(id_col), F.col("_gk").alias("keep_id"),
                           F.col("_gn").alias("group_size"), (F.col("_rn") == 1).alias("kept"),
                           F.col("_sha").alias("text_sha256"))
    rows = materialize(rows, "exact-rows")
    merged = (rows.where((F.col("_s") > 0) & (F.col("_rn") == 1)).groupBy(F.col("_sha").alias("_msha"))
              .agg(F.sum("_gn").alias("_mn"), best("_gk").alias("_mk")))
    out = rows.join(F.broadcast(merged), (F.col("_s") > 0) & (F.col("_sha") == F.col("_msha")), "left")
    is_hot = F.col("_mn").isNotNull()
    return out.select(
        F.col("_id").alias(id_col),
        F.when(is_hot, F.col("_mk")).otherwise(F.col("_gk")).alias("keep_id"),
        F.coalesce("_mn", "_gn").alias("group_size"),
        ((F.col("_rn") == 1) & (~is_hot | F.col("_gk").eqNullSafe(F.col("_mk")))).alias("kept"),
        F.col("_sha").alias("text_sha256"))
