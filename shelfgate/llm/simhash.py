"""SimHash near-dedup with fuzzy keys from the binary Golay code.

A fingerprint's 64 bits are cut into three segments of at most 23 bits. The
perfect Golay code (23, 12) puts every 23-bit word within 3 bits of exactly
one codeword; decoding a segment and all its neighbours at one bit gives one
or six codeword indices, and two segments at most 2 bits apart share one
(the word between them decodes alike for both). Errors are dealt over segments
by the pigeonhole: of at most 4 differing bits, either no segment has more
than 2, and the three indices together are a common key, or one segment has
none and another at most 2, and the bits of the first with the index of the
other are. Keys of 33 to 36 bits keep chance meetings rare. Fingerprints that
share a key are compared in full.

A key's group is never spelled out as pairs: each task walks its groups
breadth first and sends one edge per reached fingerprint. Groups above
``TILE`` fingerprints are cut into tiles by hash and every two tiles are
compared in a task of their own. Components follow from alternating star
contraction of the edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schema import col, free_prefix
from ..session import materialize
from .bitmap import bit_map, marked
from .tokens import string_column

SHINGLE_WORDS = 4
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
TILE = 8192
FILTER_BITS = 1 << 25
# Fixed value: the generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the Golay code.
GOLAY = 0b110001110101


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word divided by the generator."""
    r = words.astype(np.uint32).copy()
    for bit in range(22, 10, -1):
        r ^= np.where(r >> np.uint32(bit) & np.uint32(1), np.uint32(GOLAY << (bit - 11)), np.uint32(0))
    return r


def _error_table() -> np.ndarray:
    """The error of at most three bits for each of the 2,048 syndromes."""
    one = [1 << i for i in range(23)]
    errors = [0, *one, *(a | b for i, a in enumerate(one) for b in one[:i]),
              *(a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j])]
    e = np.array(errors, np.uint32)
    out = np.zeros(2048, np.uint32)
    out[_syndromes(e)] = e
    return out


_ERRORS = _error_table()


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within three bits of each 23-bit word."""
    return ((words.astype(np.uint32) ^ _ERRORS[_syndromes(words)]) >> np.uint32(11)).astype(np.uint32)


def segment_indices(fp: np.ndarray, segment: tuple[int, int]) -> np.ndarray:
    """Codeword indices of a segment and of its neighbours at one bit: (fingerprints, 1 + width)."""
    low, width = segment
    word = ((fp >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.uint32)
    near = np.concatenate([word[:, None], word[:, None] ^ (np.uint32(1) << np.arange(width, dtype=np.uint32))], axis=1)
    return codeword_index(near)


def fuzzy_keys(fp: np.ndarray, kinds: str = "both") -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) for the keys of an array of fingerprints:
    those with a whole segment, those of three indices, or both."""
    sets = []
    for segment in SEGMENTS:
        idx = np.sort(segment_indices(fp, segment), axis=1)
        fresh = np.ones(idx.shape, bool)
        fresh[:, 1:] = idx[:, 1:] != idx[:, :-1]
        # at most six distinct indices: packed to the left, the rest repeats the first
        at = np.argsort(~fresh, axis=1, kind="stable")[:, :6]
        ok = np.take_along_axis(fresh, at, 1)
        sets.append((np.take_along_axis(idx, at, 1).astype(np.int64), ok))
    rows, keys = [], []
    if kinds != "segment":
        (k0, ok0), (k1, ok1), (k2, ok2) = sets
        # no segment has more than two errors: the indices of all three
        key = (k0[:, :, None, None] << 24) | (k1[:, None, :, None] << 12) | k2[:, None, None, :]
        ok = ok0[:, :, None, None] & ok1[:, None, :, None] & ok2[:, None, None, :]
        rows.append(np.nonzero(ok)[0])
        keys.append(key[ok])
    if kinds == "indices":
        return rows[0], keys[0]
    # a segment has no error, so one of the others has at most two: its bits and the other's index
    for kind, (a, b) in enumerate(((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)), 1):
        low, width = SEGMENTS[a]
        bits = ((fp >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
        index, ok = sets[b]
        key = (kind << 36) | (bits[:, None] << 12) | index
        rows.append(np.nonzero(ok)[0])
        keys.append(key[ok])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text; no words give zero."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle_words + 1
    if n < 1:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e - 1], 42) for s, e in zip(starts[:n], ends[shingle_words - 1:])]
    bits = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[lo:lo + (1 << 16)], "<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle_words: int):
    def run(batches):
        for batch in batches:
            text = string_column(batch, "text").to_pylist()
            fp = np.fromiter((fingerprint(t, shingle_words) for t in text), np.uint64, len(text))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h1"), batch.column("h2"),
                                              pa.array(fp.view(np.int64))], names=["id", "h1", "h2", "fp"])
    return run


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """id, two hashes of the text, and ``fp`` (the 64 bits as a signed long) per row; null text counts as empty."""
    src = docs.select(col(id_col).alias("id"), *_hashes(text_col), col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return src.mapInArrow(_fingerprints(shingle_words), f"id {id_type}, h1 bigint, h2 bigint, fp bigint")


def _hashes(text_col: str):
    text = F.coalesce(col(text_col), F.lit(""))
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")


def _key_rows(kinds: str):
    def run(batches):
        for batch in batches:
            fp, value = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("fp", "value"))
            for lo in range(0, len(fp), 2000):
                rows, keys = fuzzy_keys(fp[lo:lo + 2000].view(np.uint64), kinds)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(value[lo:lo + 2000][rows])],
                                                 names=["key", "value"])
    return run


def stars(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member of its component) within one group, members other than it."""
    order = np.sort(fp)
    rest = order.view(np.uint64)
    members, centres = [], []
    while len(rest):
        centre, todo, rest = rest[0], [rest[0]], rest[1:]
        while todo and len(rest):
            near = np.bitwise_count(rest ^ todo.pop()) <= max_bits
            if near.any():
                got = rest[near]
                rest = rest[~near]
                members.append(got)
                centres.append(np.full(len(got), centre, np.uint64))
                todo.extend(got)
    if not members:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, c = np.concatenate(members).view(np.int64), np.concatenate(centres).view(np.int64)
    return a, c


def _group_edges(max_bits: int):
    """Edges of the groups of a partition sorted by group. Small groups are compared all at
    once; the last group of a batch waits for the next batch."""
    def edges(g: np.ndarray, fp: np.ndarray):
        if not len(g):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cuts = np.nonzero(np.concatenate([[True], (g[1:] != g[:-1]).any(axis=1)]))[0]
        sizes = np.diff(np.concatenate([cuts, [len(g)]]))
        left, right = [], []
        for size in np.unique(sizes[(sizes > 1) & (sizes <= 6)]):
            at = cuts[sizes == size]
            m = fp[at[:, None] + np.arange(size)]
            for i in range(size):
                for j in range(i):
                    near = np.bitwise_count(m[:, i].view(np.uint64) ^ m[:, j].view(np.uint64)) <= max_bits
                    near &= m[:, i] != m[:, j]
                    left.append(m[near, i])
                    right.append(m[near, j])
        for c, size in zip(cuts[sizes > 6].tolist(), sizes[sizes > 6].tolist()):
            a, b = stars(np.unique(fp[c:c + size]), max_bits)
            left.append(a)
            right.append(b)
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = np.concatenate(left), np.concatenate(right)
        low, high = np.minimum(a, b), np.maximum(a, b)
        both = np.unique(np.stack([high, low], axis=1), axis=0)
        return both[:, 0], both[:, 1]

    def run(batches):
        held_g, held_fp = [np.zeros((0, 3), np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            if not batch.num_rows:
                continue
            g = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                          for c in ("key", "ti", "tj")], axis=1)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            whole = int(np.nonzero((g != g[-1]).any(axis=1))[0][-1]) + 1 if (g != g[-1]).any() else 0
            if whole or (len(held_g[-1]) and (held_g[-1][-1] != g[0]).any()):
                a, b = edges(np.concatenate([*held_g, g[:whole]]), np.concatenate([*held_fp, fp[:whole]]))
                held_g, held_fp = [g[whole:]], [fp[whole:]]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            else:
                held_g.append(g)
                held_fp.append(fp)
        a, b = edges(np.concatenate(held_g), np.concatenate(held_fp))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return run


def links(nodes: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE, kinds: str = "both") -> DataFrame:
    """Edges (a > b) that connect the fingerprints at most ``max_bits`` apart that share a key.

    ``nodes`` has the columns ``fp``, without repeats, and ``root``, the
    component the fingerprint is known to be in (itself at first): only keys
    of more than one component are looked at. Not every such pair is an edge,
    but each is connected through edges of at most ``max_bits``.
    """
    if max_bits > 4:
        raise ValueError("the keys cover at most 4 differing bits")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = nodes.select("fp", "root").repartition(parts, "fp")

    def keyed(column: str) -> DataFrame:
        return (nodes.select("fp", F.col(column).alias("value"))
                .mapInArrow(_key_rows(kinds), "key bigint, value bigint"))

    mixed = (keyed("root").groupBy("key")
             .agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("n"))
             .where("lo <> hi").select(F.col("key").alias("k"), "n"))
    mixed = materialize(mixed, "simhash-keys")
    # the keys are made a second time; those that miss the bit map, nearly all, go no further
    rows = keyed("fp").withColumnRenamed("value", "fp")
    rows = marked(rows, "key", bit_map(mixed, "k", "seen", FILTER_BITS), "seen", FILTER_BITS).where("seen").drop("seen")
    rows = rows.join(mixed, F.col("key") == F.col("k"))
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    rows = rows.select("key", "fp", tiles.alias("tiles"))
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    rows = rows.select("key", "fp", mine.alias("t"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o"))
    rows = rows.select("key", F.least("t", "o").alias("ti"), F.greatest("t", "o").alias("tj"), "fp")
    rows = rows.repartition(parts, "key", "ti", "tj").sortWithinPartitions("key", "ti", "tj")
    return rows.mapInArrow(_group_edges(max_bits), "a bigint, b bigint").distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node of each component, for nodes that have an edge.

    Alternating large-star and small-star contraction. Each round is written
    to the shared folder, which cuts the lineage; rounds end when every edge
    points at a root. ``a > b`` must hold for the edges.
    """
    edges = materialize(edges, "edges")
    state = None
    for _ in range(max_rounds):
        # large star: neighbours above a node move to the smallest node around it
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, F.col("a") == F.col("u"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        moved = large.join(low, F.col("a") == F.col("u"))
        small = (moved.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        edges = materialize(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def linked_components(distinct: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(node, root) of the fingerprints in the column ``fp``, without repeats.

    The fewer keys with a whole segment come first; the keys of three indices
    then need only find links between the components known by then, so a
    large group of close fingerprints is not walked once more for each key.
    """
    first = components(links(distinct.select("fp", F.col("fp").alias("root")), max_bits, tile, "segment"))
    known = (distinct.join(first, F.col("fp") == F.col("node"), "left")
             .select("fp", F.coalesce("root", "fp").alias("root")))
    second = links(known, max_bits, tile, "indices")
    return components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(second).distinct())


def _named(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp``, its ``root``, and ``best``: the smallest (id is null, id, hashes) of its rows."""
    best = F.min(F.struct(F.col("id").isNull().alias("nul"), "id", "h1", "h2")).alias("best")
    reps = materialize(fps.groupBy("fp").agg(best), "simhash-distinct")
    roots = linked_components(reps.select("fp"), max_bits)
    return (reps.join(roots, F.col("fp") == F.col("node"), "left")
            .select("fp", "best", F.coalesce("root", "fp").alias("root")))


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """id, ``fp`` (signed long) and ``component_id`` per row of ``docs``.

    Words are runs of anything but ASCII white space after lower-casing A-Z;
    shingles count with repeats, shorter texts are one shingle, and texts
    without words (null and empty ones too) have fingerprint zero, which links
    like any other. ``component_id`` is the smallest id reachable over links
    of at most ``max_bits`` differing bits; null ids are passed over, and a
    component without any id has a null one. Repeated rows stay. Other columns
    are ignored; an empty table gives an empty result.
    """
    fps = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words), "simhash")
    named = _named(fps, max_bits)
    lowest = named.groupBy("root").agg(F.min("best").alias("least")).withColumnRenamed("root", "r")
    found = (named.join(lowest, F.col("root") == F.col("r"))
             .select(F.col("fp").alias("cfp"), F.col("least.id").alias("component_id")))
    return fps.join(found, F.col("fp") == F.col("cfp")).select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id (rows without an id
    come last), among rows of one id that of the smallest hash of the text.

    Of rows that repeat id and text one stays; every component keeps exactly
    one row, however ids are repeated or missing. Columns may have any name.
    """
    fps = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words), "simhash")
    least = _named(fps, max_bits).groupBy("root").agg(F.min("best").alias("least"))
    p = free_prefix(docs.columns)
    best = materialize(least.select(F.col("least.id").alias(p + "id"), F.col("least.h1").alias(p + "b1"),
                                    F.col("least.h2").alias(p + "b2")), "simhash-best")
    counts = fps.groupBy("id", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    same = (F.col("h1") == F.col(p + "b1")) & (F.col("h2") == F.col(p + "b2"))
    doubtful = counts.join(best, same & F.col("id").eqNullSafe(F.col(p + "id")), "left")
    doubtful = materialize(doubtful.where(F.col(p + "b1").isNull() | (F.col("n") > 1))
                           .select(F.xxhash64("id", "h1", "h2").alias("h")), "simhash-doubtful")
    # Rows that are one of a kind and stay do not move; only those that may go, or repeat, meet the best ones.
    h1, h2 = _hashes(text_col)
    rows = docs.select("*", h1.alias(p + "h1"), h2.alias(p + "h2"))
    rows = rows.withColumn(p + "h", F.xxhash64(col(id_col), p + "h1", p + "h2"))
    rows = marked(rows, p + "h", bit_map(doubtful, "h", p + "m"), p + "m")
    same = (F.col(p + "h1") == F.col(p + "b1")) & (F.col(p + "h2") == F.col(p + "b2"))
    met = rows.where(F.col(p + "m")).join(best, same & col(id_col).eqNullSafe(F.col(p + "id")), "left_semi")
    whole = F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    once = met.groupBy(p + "h1", p + "h2", col(id_col).alias(p + "id")).agg(F.first(whole).alias(p + "row"))
    return (rows.where(~F.col(p + "m")).select(*[col(c) for c in docs.columns])
            .unionAll(once.select(*[F.col(f"{p}row.c{i}").alias(c) for i, c in enumerate(docs.columns)])))
