"""Substring dedup by level-wise doubling of repeated windows.

Level by level, word windows of ``base_words``, twice that, and so on up to
``min_words`` are compared; only windows whose parts were repeated at one
length are extended to twice that length. At the first level a window is
represented by one anchor, the part with the smallest hash in it: equal
windows have equal anchors, so a window with an anchor found once in the
corpus cannot be repeated, and a sixth of the positions need comparing.

Texts are dealt into blocks (:mod:`.blocks`). A block sends each distinct
hash once, so a passage in a third of all documents makes as many rows as
there are blocks, not documents. At the last level the earliest start of
each window, of those each block sends, is the one that stays. There and in
the removal a window is known by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks

MIN_WORDS = 20
BASE_WORDS = 10


def _mix(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hash of two 64-bit hashes (multiply and xor-shift, wrapping)."""
    with np.errstate(over="ignore"):
        x = (a ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x = (x + b) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Block:
    """The words of a block's documents, in id order, and hashes of their windows."""

    def __init__(self, table: pa.Table):
        self.table = blocks.in_order(table)
        text = blocks.texts(self.table)
        lists = pc.ascii_split_whitespace(text)
        words, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        real = pc.not_equal(words, "")
        keep = real.to_numpy(zero_copy_only=False)
        if len(keep) and not keep.all():
            offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
            words = words.filter(real)
        self.offsets = offsets
        coded = words.dictionary_encode()
        self.words = coded
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = [w.as_buffer().to_pybytes() for w in coded.dictionary.cast(pa.binary())]
        self.h = [np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in names), np.uint64, len(names))[self.codes]
                  if len(names) else np.zeros(0, np.uint64) for seed in (0, 1)]

    def windows(self, n: int, which: int = 0) -> np.ndarray:
        """Hash of the ``n`` words from every position; positions too near the end give rubbish."""
        h = self.h[which]
        out, size = h, 1
        # binary method: doubled windows, and one word more where the length is odd
        for bit in bin(n)[3:]:
            nxt = np.zeros_like(out)
            nxt[:max(len(h) - size, 0)] = _mix(out[:max(len(h) - size, 0)], out[size:], size)
            out, size = nxt, 2 * size
            if bit == "1":
                nxt = np.zeros_like(out)
                nxt[:max(len(h) - size, 0)] = _mix(out[:max(len(h) - size, 0)], h[size:], size)
                out, size = nxt, size + 1
        return out

    def starts(self, n: int) -> np.ndarray:
        """Positions at which ``n`` words of one document follow."""
        counts = np.maximum(np.diff(self.offsets) - n + 1, 0)
        first = np.repeat(self.offsets[:-1], counts)
        return first + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)

    def anchors(self, h: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
        """For every start, the position with the smallest of the ``span`` hashes from there."""
        at = starts.copy()
        low = h[starts]
        for k in range(1, span):
            v = h[starts + k]
            less = v < low
            at[less] = starts[less] + k
            low = np.minimum(low, v)
        return at


def _block_id(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _first_level(base: int, target: int):
    def run(table: pa.Table) -> pa.Table:
        b = _Block(table)
        starts, h = b.starts(target), b.windows(base)
        used = np.unique(b.anchors(h, starts, target - base + 1)) if len(starts) else starts
        found, n = np.unique(h[used], return_counts=True)
        return pa.table({"block": pa.array(np.full(len(found), _block_id(table), np.int32)), "h": _signed(found),
                         "n": pa.array(n.astype(np.int32))})
    return run


def _candidates(b: _Block, base: int, target: int, h: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Starts of target windows whose anchor is repeated."""
    starts = b.starts(target)
    if not len(starts) or not len(repeated):
        return starts[:0]
    at = b.anchors(h, starts, target - base + 1)
    values = h[at]
    i = np.minimum(np.searchsorted(repeated, values), len(repeated) - 1)
    return starts[repeated[i] == values]


def _repeated(found: pa.Table) -> np.ndarray:
    return np.sort(found.column("h").to_numpy().astype(np.int64).view(np.uint64))


def _first_of_equals(h: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """For each window, the position of the first one with the same two hashes."""
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    out = first[inverse]
    if (h2[out] != h2).any():  # two windows share a hash
        _, first, inverse = np.unique(np.stack([h, h2], axis=1), axis=0, return_index=True, return_inverse=True)
        out = first[inverse.ravel()]
    return out


def _among(h: np.ndarray, h2: np.ndarray, found: pa.Table) -> np.ndarray:
    """Whether the two hashes of a window are those of a row of ``found``."""
    f, f2 = (found.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("h", "h2"))
    order = np.argsort(f, kind="stable")
    f, f2 = f[order], f2[order]
    low = np.searchsorted(f, h)
    at = np.minimum(low, len(f) - 1)
    hit = (f[at] == h) & (f2[at] == h2)
    for k in np.nonzero((f[at] == h) & ~hit)[0]:  # rows that share a hash
        hit[k] = (f2[low[k]:np.searchsorted(f, h[k], side="right")] == h2[k]).any()
    return hit


def _middle_level(base: int, length: int, target: int):
    """Windows of ``length`` whose halves were repeated; later levels look only at those."""
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows or not found.num_rows:
            return pa.table({"block": pa.array([], pa.int32()), "h": pa.array([], pa.int64()),
                             "n": pa.array([], pa.int32())})
        b = _Block(docs)
        half, whole = b.windows(length // 2), b.windows(length)
        rep = _repeated(found)
        starts = b.starts(target)
        span = target - length + 1
        if length // 2 == base:
            ok = np.zeros(len(half) + 1, bool)
            cand = _candidates(b, base, target, half, rep)
        else:
            ok = np.isin(half, rep)
            cand = starts[np.logical_and.reduce([ok[starts + k] for k in range(0, target - length // 2 + 1)])]
        used = np.unique((cand[:, None] + np.arange(span)).ravel())
        values, n = np.unique(whole[used], return_counts=True)
        return pa.table({"block": pa.array(np.full(len(values), _block_id(docs), np.int32)), "h": _signed(values),
                         "n": pa.array(n.astype(np.int32))})
    return run


def _last_level(base: int, target: int, anchored: bool, id_type: pa.DataType):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        none = pa.table({"block": pa.array([], pa.int32()), "h": pa.array([], pa.int64()),
                         "h2": pa.array([], pa.int64()), "id": pa.array([], id_type), "start": pa.array([], pa.int32())})
        if not docs.num_rows or not found.num_rows:
            return none
        b = _Block(docs)
        if anchored:
            cand = _candidates(b, base, target, b.windows(base), _repeated(found))
        else:
            half = np.isin(b.windows(target // 2), _repeated(found))
            starts = b.starts(target)
            cand = starts[half[starts] & half[starts + target // 2]]
        if not len(cand):
            return none
        # starts ascend, so the first of equal windows is the earliest of the block
        h, h2 = b.windows(target)[cand], b.windows(target, 1)[cand]
        first = _first_of_equals(h, h2) == np.arange(len(cand))
        at = cand[first]
        doc = np.searchsorted(b.offsets, at, side="right") - 1
        return pa.table({"block": pa.array(np.full(len(at), _block_id(docs), np.int32)), "h": _signed(h[first]),
                         "h2": _signed(h2[first]),
                         "id": b.table.column("id").combine_chunks().take(pa.array(doc)),
                         "start": pa.array((at - b.offsets[doc]).astype(np.int32))})
    return run


def _remove(target: int):
    def run(docs: pa.Table, later: pa.Table) -> pa.Table:
        b = _Block(docs)
        n = np.diff(b.offsets)
        gone = np.zeros(len(b.codes) + 1, np.int64)
        starts = b.starts(target)
        if len(starts):
            h, h2 = b.windows(target)[starts], b.windows(target, 1)[starts]
            dup = _first_of_equals(h, h2) != np.arange(len(h))
            if later.num_rows:
                dup |= _among(h, h2, later)
            np.add.at(gone, starts[dup], 1)
            np.add.at(gone, starts[dup] + target, -1)
        kept = np.cumsum(gone[:-1]) == 0
        text = []
        removed = []
        for s, e in zip(b.offsets[:-1].tolist(), b.offsets[1:].tolist()):
            k = kept[s:e]
            words = b.words.dictionary.take(pa.array(b.codes[s:e][k]))
            text.append(" ".join(words.to_pylist()))
            removed.append(int((~k).sum()))
        return pa.table({"id": b.table.column("id"), "n_words": pa.array(n), "n_removed": pa.array(removed, pa.int64()),
                         "kept_text": pa.array(text, pa.string())})
    return run


def _digest(run):
    """The same rows with the SHA-256 of the kept text in its place."""
    def digested(docs: pa.Table, later: pa.Table) -> pa.Table:
        t = run(docs, later)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in t.column("kept_text").to_pylist()]
        return t.set_column(3, "kept_sha256", pa.array(sha, pa.string()))
    return digested


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                   base_words: int = BASE_WORDS, digest: bool = False,
                   block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept_text`` (``kept_sha256`` if ``digest``).

    A word goes when a window of ``min_words`` words covers it whose word
    sequence also starts earlier: in a document of smaller id, or earlier in
    the same document. Windows are judged on the input. ``min_words`` must be
    ``base_words`` times a power of two. Longer repeats need no further
    levels: they are covered by the windows of ``min_words``.

    Null text counts as empty (no words, nothing removed). Null ids sort last.
    Rows that repeat id and text are documents of their own in the order of
    the block; rows that repeat an id with other texts are ordered by their
    compressed text. Other columns are ignored; an empty table gives none.
    """
    levels = [base_words]
    while levels[-1] < min_words:
        levels.append(2 * levels[-1])
    if levels[-1] != min_words or len(levels) < 2:
        raise ValueError("min_words must be base_words times a power of two, at least two")
    dealt, parts = blocks.dealt(docs, id_col, text_col, block_bytes)
    grouped = dealt.groupBy("block")
    id_field = docs.schema[id_col].dataType
    id_type = id_field.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    by_hash = Window.partitionBy("h")

    def repeated(level: DataFrame) -> DataFrame:
        """Hashes found twice, with the blocks they came from (a block counts once)."""
        return (level.withColumn("all", F.sum("n").over(by_hash)).where("all > 1").select("block", "h")
                .repartition(parts, "block"))

    found = repeated(grouped.applyInArrow(_first_level(base_words, min_words), "block int, h bigint, n int"))
    for length in levels[1:-1]:
        found = repeated(grouped.cogroup(found.groupBy("block")).applyInArrow(
            _middle_level(base_words, length, min_words), "block int, h bigint, n int"))
    firsts = grouped.cogroup(found.groupBy("block")).applyInArrow(
        _last_level(base_words, min_words, len(levels) == 2, to_arrow_type(id_field)),
        f"block int, h bigint, h2 bigint, id {id_type}, start int")
    order = Window.partitionBy("h", "h2").orderBy(F.asc_nulls_last("id"), "start", "block")
    later = (firsts.withColumn("rn", F.row_number().over(order)).where("rn > 1").select("block", "h", "h2")
             .repartition(parts, "block"))
    run = _remove(min_words)
    out = grouped.cogroup(later.groupBy("block")).applyInArrow(
        _digest(run) if digest else run,
        f"id {id_type}, n_words bigint, n_removed bigint, {'kept_sha256' if digest else 'kept_text'} string")
    return out.withColumnRenamed("id", id_col)
