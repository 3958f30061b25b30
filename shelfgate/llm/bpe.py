"""BPE encoding and decoding over a distinct-word table.

Encoding: the texts are dealt into blocks; each block gives its distinct
words, dealt again by word, so that all blocks' copies of a word meet in one
bucket, where each distinct word is encoded once; the ids go back to their
blocks and are joined to the texts by position. Decoding takes nothing but
ids: an id-to-piece join (by position in the vocabulary's bounded table)
gives the pieces, joined as the tokenizer's ``decode`` joins them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame

from . import blocks
from .tokens import encoder, gather

BUCKETS_PER_BLOCK = 2


def _pack(words: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress("\n".join(words).encode())


def _unpack(z: bytes) -> list[str]:
    return zstandard.ZstdDecompressor().decompress(z).decode().split("\n")


def _word_lists(words: pa.Array, buckets: int) -> list[list[str]]:
    """A block's distinct words, sorted, by bucket. Words hold no line break."""
    out: list[list[str]] = [[] for _ in range(buckets)]
    for w in sorted(w for w in words.to_pylist() if w):
        out[xxhash.xxh64_intdigest(w) % buckets].append(w)
    return out


def _distinct_words(path: str, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        words = encoder(path).split(blocks.texts(table))[1].unique()
        pa.default_memory_pool().release_unused()
        lists = _word_lists(words, buckets)
        used = [b for b, ws in enumerate(lists) if ws]
        block = table.column("block")[0].as_py()
        return pa.table({"bucket": pa.array(used, pa.int32()), "block": pa.array([block] * len(used), pa.int32()),
                         "words": pa.array([_pack(lists[b]) for b in used], pa.binary())})
    return run


def _encode_bucket(path: str):
    def run(table: pa.Table) -> pa.Table:
        lists = [_unpack(z) for z in table.column("words").to_pylist()]
        # the bucket's part of the distinct-word table
        words = sorted(set().union(*lists))
        ids = dict(zip(words, encoder(path).encode(pa.array(words, pa.string()))))
        c = zstandard.ZstdCompressor(level=1)
        out = []
        for ws in lists:
            got = [ids[w] for w in ws]
            n = np.fromiter((len(b) // 4 for b in got), "<u4", len(got))
            out.append(c.compress(n.tobytes() + b"".join(got)))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "ids": pa.array(out, pa.binary())})
    return run


def _join_ids(path: str, buckets: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"id": docs.column("id"), "ids": pa.array([], pa.binary())})
        offsets, words = encoder(path).split(blocks.texts(docs))
        coded = words.dictionary_encode()
        distinct, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lists = _word_lists(distinct, buckets)
        ids: dict[str, bytes] = {"": b""}
        d = zstandard.ZstdDecompressor()
        for b, z in zip(found.column("bucket").to_pylist(), found.column("ids").to_pylist()):
            raw = d.decompress(z)
            n = np.frombuffer(raw, "<u4", len(lists[b]))
            ends = (len(lists[b]) + np.cumsum(n, dtype=np.int64)) * 4
            starts = ends - n.astype(np.int64) * 4
            ids.update(zip(lists[b], (raw[s:e] for s, e in zip(starts.tolist(), ends.tolist()))))
        flat, at = gather(codes, [ids[w] for w in distinct.to_pylist()])
        del words, coded, codes, lists, ids
        cut = at[offsets]
        raw = flat.tobytes()
        del flat, at
        pa.default_memory_pool().release_unused()
        rows = [raw[4 * s:4 * e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]
        return pa.table({"id": docs.column("id"), "ids": pa.array(rows, pa.binary())})
    return run


def encode(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``id_col`` and ``ids`` (binary, little-endian unsigned 32-bit).

    Ids are those of the tokenizers library on the whole text, special tokens
    not added, truncation and padding unused; special tokens that stand in a
    text keep their own id. Null and empty texts give no ids; null ids and
    repeated rows keep their row. Other columns are ignored. The tokenizer
    file must be readable under the same path on every executor.
    """
    dealt, parts = blocks.dealt(docs, id_col, text_col, block_bytes)
    buckets = max(1, BUCKETS_PER_BLOCK * parts)
    id_type = docs.schema[id_col].dataType.simpleString()
    lists = dealt.groupBy("block").applyInArrow(_distinct_words(tokenizer_path, buckets),
                                                "bucket int, block int, words binary")
    found = (lists.repartition(parts, "bucket").groupBy("bucket")
             .applyInArrow(_encode_bucket(tokenizer_path), "block int, bucket int, ids binary")
             .repartition(parts, "block"))
    out = (dealt.groupBy("block").cogroup(found.groupBy("block"))
           .applyInArrow(_join_ids(tokenizer_path, buckets), f"id {id_type}, ids binary"))
    return out.withColumnRenamed("id", id_col)


def _decode_batches(path: str, others: list[str], rows: int = 256):
    def run(batches):
        tk = encoder(path).tokenizer
        n = tk.get_vocab_size(with_added_tokens=True)
        pieces = pa.array([tk.id_to_token(i) or "" for i in range(n)], pa.string())
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                b = batch.slice(lo, rows)
                raw = [x.as_py() or b"" for x in b.column("ids")]
                if tk.decoder is None:
                    ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
                    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])])
                    lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pieces.take(pa.array(ids)))
                    text = pc.binary_join(lists, " ").cast(pa.string())
                else:
                    text = pa.array([tk.decode(np.frombuffer(x, "<u4").tolist(), skip_special_tokens=False)
                                     for x in raw], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(c) for c in others] + [text], names=[*others, "decoded"])
    return run


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``encoded`` plus ``decoded``: what the library's decode(ids, skip_special_tokens=False)
    gives for the column ``ids``. No ids, or null, give the empty string. A column named
    ``decoded`` is replaced. The piece table has the vocabulary's size, whatever the input."""
    src = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema) + ", decoded string"
    return src.mapInArrow(_decode_batches(tokenizer_path, src.columns), schema)
