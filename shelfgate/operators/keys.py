"""Key multiplicity without skew.

Flagging every row whose key repeats is the core of the uniqueness rule and
the duplicate audit. A plain ``count().over(Window.partitionBy(key))`` shuffles
every full row and puts all rows of one key (and all null keys) into one
task; a third of the data may share one key. Two tools replace it, with one
plan for every input size:

* :func:`repeated_keys` — the keys that occur more than once, with counts.
  Keys are first counted by a 64-bit hash (8 bytes per key in the shuffle,
  combined map-side). The repeated hashes become a bit map of fixed size
  (``FILTER_BITS``); only rows that hit it — true repeats, rare collisions
  and false hits — are grouped on the real key. Exact.
* :func:`attach_repeats` — brings those counts back to the rows. Up to
  ``MAX_BROADCAST_BYTES`` of repeated keys are broadcast and the rows never
  move. Beyond, rows that miss the bit map pass through where they are and
  only the others are shuffled to the repeated keys. Keys with more than
  ``T`` rows ("hot" keys) do not take part in that join: ``T`` is at least
  the number of repeated rows over ``MAX_HOT_KEYS``, so there are at most
  that many of them, they are broadcast with their counts, and their rows
  are spread by a random salt.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.schema import col, free_prefix
from ..session import env_int, estimated_bytes, materialize

HOT_ROWS_FLOOR = env_int("SHELFGATE_HOT_ROWS", 1_000_000)
MAX_HOT_KEYS = env_int("SHELFGATE_MAX_HOT_KEYS", 100_000)
SALT_BUCKETS = env_int("SHELFGATE_SALT_BUCKETS", 64)
# bytes of the repeated keys' files (compressed) up to which they are broadcast
MAX_BROADCAST_BYTES = env_int("SHELFGATE_MAX_BROADCAST_BYTES", 16 << 20)
# 8 MB of bits, at most a million (word, bits) rows; a full map only saves less
FILTER_BITS = env_int("SHELFGATE_FILTER_BITS", 1 << 26)


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def key_hash(df: DataFrame, keys: list[str]) -> Column:
    """64-bit hash of a key; null parts are marked so (null, x) differs from (x, null).

    Floating parts are normalized first (-0.0 to 0.0), as ``GROUP BY`` does,
    so values a grouping treats as equal also hash equal.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for k in keys:
        c = col(k)
        if isinstance(types.get(k), (DoubleType, FloatType)):
            c = F.when(c == 0, F.lit(0.0).cast(types[k])).otherwise(c)
        parts += [c, col(k).isNull()]
    return F.xxhash64(*parts)


def _bit(hash_col: str) -> str:
    return f"pmod(`{hash_col}`, {FILTER_BITS}L)"


def _bit_map(hashes: DataFrame, hash_col: str, p: str) -> DataFrame:
    """(word, bits) of the hashes; at most ``FILTER_BITS / 64`` rows, so it may be broadcast."""
    bit = _bit(hash_col)
    return (hashes.groupBy(F.expr(f"CAST({bit} DIV 64 AS INT)").alias(p + "word"))
            .agg(F.expr(f"bit_or(shiftleft(1L, CAST({bit} % 64 AS INT)))").alias(p + "bits")))


def _tested(df: DataFrame, hash_col: str, words: DataFrame, p: str) -> DataFrame:
    """``df`` with the boolean ``<p>hit``: the bit of its hash is set."""
    bit = _bit(hash_col)
    hit = F.expr(f"coalesce(shiftrightunsigned(`{p}bits`, CAST({bit} % 64 AS INT)) & 1L = 1L, false)")
    return (df.join(F.broadcast(words), F.expr(f"CAST({bit} DIV 64 AS INT) = `{p}word`"), "left")
            .withColumn(p + "hit", hit))


def marked_repeats(df: DataFrame, key_sets: dict[str, list[str]]) -> DataFrame:
    """``df`` with a boolean column per key set, named by its dictionary key: the key may repeat.

    False means that the key occurs once or has a null part. One scan of the
    key columns serves all sets; it counts 64-bit hashes and leaves a bit map of
    fixed size, which is broadcast.
    """
    p = free_prefix([*df.columns, *key_sets])
    hashes = {name: F.when(_all([col(k).isNotNull() for k in keys]), F.xxhash64(F.lit(i), key_hash(df, keys)))
              for i, (name, keys) in enumerate(key_sets.items())}
    hashed = df.select(F.explode(F.array(*hashes.values())).alias(p + "kh")).where(F.col(p + "kh").isNotNull())
    cand = materialize(hashed.groupBy(p + "kh").agg(F.count(F.lit(1)).alias(p + "c"))
                       .where(F.col(p + "c") > 1).select(p + "kh"), "key-hash-candidates")
    words = _bit_map(cand, p + "kh", p)
    out = df
    for name, kh in hashes.items():
        tested = _tested(out.withColumn(p + "kh", kh), p + "kh", words, p)
        out = tested.select(*[col(c) for c in out.columns],
                            (F.col(p + "kh").isNotNull() & F.col(p + "hit")).alias(name))
    return out


def repeated_keys(df: DataFrame, keys: list[str], *, nulls_equal: bool,
                  count_col: str = "_n") -> DataFrame:
    """Keys occurring more than once, with their count. Exact.

    ``nulls_equal=False``: a key with a null part matches nothing (SQL
    equality). ``nulls_equal=True``: null parts are equal to each other
    (``dropDuplicates`` / ``GROUP BY`` semantics).
    """
    src = df if nulls_equal else df.where(_all([col(k).isNotNull() for k in keys]))
    p = free_prefix(keys)
    hashed = src.select(*[col(k) for k in keys], key_hash(src, keys).alias(p + "kh"))
    cand = materialize(hashed.groupBy(p + "kh").agg(F.count(F.lit(1)).alias(p + "c"))
                       .where(F.col(p + "c") > 1).select(p + "kh"), "key-hash-candidates")
    hits = _tested(hashed, p + "kh", _bit_map(cand, p + "kh", p), p).where(F.col(p + "hit"))
    return (hits.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) > 1))


def attach_repeats(df: DataFrame, keys: list[str], repeats: DataFrame, out_col: str, *,
                   nulls_equal: bool, count_col: str = "_n") -> DataFrame:
    """Add ``out_col`` = rows sharing the key when it repeats, else 1.

    ``repeats`` is the materialized output of :func:`repeated_keys` with the
    same ``nulls_equal``; without it a key with a null part gets a null.
    """
    cols = df.columns
    p = free_prefix(cols)
    nonnull = _all([col(k).isNotNull() for k in keys])

    def counts(frame: DataFrame, name: str) -> tuple[DataFrame, Column]:
        side = frame.select(*[col(k).alias(f"{p}{name}{i}") for i, k in enumerate(keys)],
                            F.col(count_col).alias(f"{p}{name}n"))
        return side, _all([
            (col(k).eqNullSafe(F.col(f"{p}{name}{i}")) if nulls_equal else col(k) == F.col(f"{p}{name}{i}"))
            for i, k in enumerate(keys)])

    def result(frame: DataFrame, *found: Column) -> DataFrame:
        n = F.coalesce(*found, F.lit(1).cast("long"))
        return frame.select(*[col(c) for c in cols], (n if nulls_equal else F.when(nonnull, n)).alias(out_col))

    side, same = counts(repeats, "r")
    if estimated_bytes(repeats) <= MAX_BROADCAST_BYTES:
        return result(df.join(F.broadcast(side), same, "left"), F.col(p + "rn"))

    words = _bit_map(repeats.select(key_hash(repeats, keys).alias(p + "kh")), p + "kh", p)
    tested = _tested(df.withColumn(p + "kh", key_hash(df, keys)), p + "kh", words, p)
    rows = repeats.agg(F.sum(count_col)).first()[0] or 0
    hot = repeats.where(F.col(count_col) > max(HOT_ROWS_FLOOR, -(-rows // MAX_HOT_KEYS)))
    hot_side, hot_same = counts(hot, "h")
    rest = tested.where(F.col(p + "hit")).join(F.broadcast(hot_side), hot_same, "left")
    # salt 0 meets the repeated keys; rows of hot keys, and null keys that match nothing, are spread
    apart = F.col(p + "hn").isNotNull() if nulls_equal else F.col(p + "hn").isNotNull() | ~nonnull
    salt = F.when(apart, 1 + F.floor(F.rand(17) * SALT_BUCKETS)).otherwise(0).cast("int")
    rest = (rest.withColumn(p + "salt", salt)
            .join(side.withColumn(p + "zero", F.lit(0)), same & (F.col(p + "salt") == F.col(p + "zero")), "left"))
    return result(tested.where(~F.col(p + "hit"))).unionAll(result(rest, F.col(p + "hn"), F.col(p + "rn")))


def with_key_count(df: DataFrame, keys: list[str], out_col: str = "_key_n", *, nulls_equal: bool = False) -> DataFrame:
    """Add the exact number of rows sharing the row's key (see :func:`attach_repeats`)."""
    repeats = materialize(repeated_keys(df, keys, nulls_equal=nulls_equal), "repeated-keys")
    return attach_repeats(df, keys, repeats, out_col, nulls_equal=nulls_equal)
