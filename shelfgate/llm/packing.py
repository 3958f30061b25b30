"""Packing documents into fixed-length sequences: shortest-pack-first over the length histogram.

Documents are tokenized and cut into pieces of at most ``max_len`` ids. Only
the histogram of piece lengths (at most ``max_len`` numbers) goes to the
driver, which places lengths longest first, each into the pack that is
shortest so far (the most room left), and updates how often every packing
pattern is used. Pieces then find their pattern, sequence and offset by
their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize
from .tokens import encoder, gather, string_column

MAX_LEN = 2048
END_ID = 1
ROWS = 200
RANK_BUCKET_ROWS = 200_000


def _pieces(path: str, end_id: int | None, max_len: int, with_ids: bool):
    tail = b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                offsets, words = enc.split(string_column(part, "text"))
                coded = words.dictionary_encode()
                flat, at = gather(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                                  enc.encode_cached(coded.dictionary))
                cut, raw = at[offsets].tolist(), flat.tobytes()
                rows = []
                for k, doc in enumerate(part.column("id").to_pylist()):
                    ids = raw[4 * cut[k]:4 * cut[k + 1]] + tail
                    total = len(ids) // 4
                    for start in range(0, total, max_len):
                        piece = ids[4 * start:4 * (start + max_len)]
                        rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), total, piece))
                cols = list(zip(*rows)) or [()] * 6
                arrays = [pa.array(cols[0], part.column("id").type), *[pa.array(c, pa.int64()) for c in cols[1:5]]]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    arrays.append(pa.array(cols[5], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def pieces(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
           max_len: int = MAX_LEN, end_id: int | None = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens (and the ids as binary)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = (f"id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
              + ", ids binary" * with_ids)
    return src.mapInArrow(_pieces(tokenizer_path, end_id, max_len, with_ids), schema)


def shortest_pack_first(histogram: Mapping[int, int], max_len: int) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, rank end, first sequence, offset) for every length.

    Packs with equal contents are one pattern with a count. A length goes to
    the patterns with the most room, splitting a pattern when fewer of its
    packs are needed, and opens new packs when none has room. The number of
    patterns depends on the number of lengths, not on their counts.
    """
    open_at: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted((n for n in histogram if histogram[n]), reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in open_at if r >= length), default=None)
            if room is None:
                count, pattern, room = left, (), max_len
            else:
                count, pattern = open_at[room].pop()
                if count > left:
                    open_at[room].append((count - left, pattern))
                    count = left
                if not open_at[room]:
                    del open_at[room]
            open_at.setdefault(room - length, []).append((count, (*pattern, length)))
            left -= count
    placed, used, sequence = [], dict.fromkeys(histogram, 0), 0
    for room in sorted(open_at):
        for count, pattern in open_at[room]:
            offset = 0
            for length in pattern:
                rank = used[length]
                placed.append((length, rank, rank + count, sequence, offset))
                used[length] = rank + count
                offset += length
            sequence += count
    return placed


def pack(parts: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """``parts`` (see :func:`pieces`; written once, for it is read twice) plus ``sequence_id`` and ``offset``.

    Ranks: the pieces of a length are dealt into buckets of about
    ``RANK_BUCKET_ROWS`` by hash, counted by bucket, and numbered within
    their bucket from the count of the buckets before, so one frequent length
    does not meet in one task. Pieces equal in id and start are told apart by
    nothing else and take any order.
    """
    spark = parts.sparkSession
    parts = materialize(parts, "pieces")
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}
    placed = shortest_pack_first(counts, max_len)
    table = spark.createDataFrame(placed, StructType([StructField(n, LongType()) for n in
                                                      ("p_length", "lo", "hi", "first", "offset")]))
    dealt = spark.createDataFrame([(n, -(-c // RANK_BUCKET_ROWS)) for n, c in counts.items()],
                                  StructType([StructField(n, LongType()) for n in ("d_length", "buckets")]))
    # both tables have at most a few rows for each of the max_len lengths
    rows = (parts.join(F.broadcast(dealt), F.col("length") == F.col("d_length"))
            .withColumn("bucket", F.pmod(F.xxhash64("id", "start"), F.col("buckets"))).drop("d_length", "buckets"))
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("length").alias("s_length"), F.col("bucket").alias("s_bucket"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("id", "start")
    ranked = (rows.withColumn("rn", F.row_number().over(within))
              .join(sizes, (F.col("length") == F.col("s_length")) & (F.col("bucket") == F.col("s_bucket")))
              .withColumn("rank", F.col("base") + F.col("rn") - 1))
    out = ranked.join(F.broadcast(table), (F.col("length") == F.col("p_length"))
                      & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return out.select(*parts.columns, (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"),
                      F.col("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                   max_len: int = MAX_LEN, end_id: int | None = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document is its ids followed by ``end_id``; null text counts as empty
    and leaves the end id alone. Pieces lie in a sequence without gaps from
    offset 0. Null ids and repeated rows are packed like any other row; other
    columns are ignored; an empty table gives an empty result.
    """
    parts = pieces(docs, tokenizer_path, id_col=id_col, text_col=text_col, max_len=max_len, end_id=end_id,
                   with_ids=with_ids)
    return pack(parts, max_len).withColumnRenamed("id", id_col)
