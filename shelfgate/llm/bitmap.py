"""A bit map of fixed size over 64-bit hashes: rows that miss it need no shuffle.

Its table has at most ``bits / 64`` rows, so it may be broadcast whatever the
input. A hit may be false; what hits is joined by its real key afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def bit_map(hashes: DataFrame, column: str, name: str, bits: int = BITS) -> DataFrame:
    """(``<name>_word``, ``<name>_bits``) of the hashes in ``column``."""
    bit = f"pmod(`{column}`, {bits}L)"
    return (hashes.groupBy(F.expr(f"CAST({bit} DIV 64 AS INT)").alias(f"{name}_word"))
            .agg(F.expr(f"bit_or(shiftleft(1L, CAST({bit} % 64 AS INT)))").alias(f"{name}_bits")))


def marked(rows: DataFrame, column: str, words: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """``rows`` with the boolean ``name``: the bit of the hash in ``column`` is set in ``words``."""
    bit = f"pmod(`{column}`, {bits}L)"
    hit = F.expr(f"coalesce(shiftrightunsigned({name}_bits, CAST({bit} % 64 AS INT)) & 1L = 1L, false)")
    joined = rows.join(F.broadcast(words), F.expr(f"CAST({bit} DIV 64 AS INT) = {name}_word"), "left")
    return joined.withColumn(name, hit).drop(f"{name}_word", f"{name}_bits")
