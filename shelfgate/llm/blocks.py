"""Documents dealt into blocks of bounded size, compressed for the shuffle.

Operators that look at a document more than once read one shuffle of the
texts several times (Spark reuses the exchange) and join what they learn by
block, so a text crosses the network once.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20


def dealt(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(block, id, zstd-compressed text) hash-partitioned by block, and the number of partitions.

    A row's block follows from its id and text alone. A block holds
    ``block_bytes`` of text on average; null texts count as empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    parts = max(n, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    src = src.select(F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int").alias("block"), "id", "text")
    id_type = docs.schema[id_col].dataType.simpleString()
    return src.mapInArrow(_compress, f"block int, id {id_type}, z binary").repartition(parts, "block"), parts


def _compress(batches):
    c = zstandard.ZstdCompressor(level=1)
    for b in batches:
        z = [c.compress(t.as_buffer()) for t in b.column("text").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([b.column("block"), b.column("id"), pa.array(z, pa.binary())],
                                         names=["block", "id", "z"])


def texts(table: pa.Table) -> pa.Array:
    """The texts of a block, in the order of its rows."""
    d = zstandard.ZstdDecompressor()
    return pa.array([d.decompress(z.as_buffer()) for c in table.column("z").chunks for z in c],
                    pa.binary()).cast(pa.string())


def in_order(table: pa.Table) -> pa.Table:
    """Rows sorted so that every pass over a block sees them alike (ids ascending, nulls last)."""
    return table.sort_by([("id", "ascending"), ("z", "ascending")])
