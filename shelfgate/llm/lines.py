"""Line dedup: exact repeats and lines within one edit of an earlier line (SQL functions only).

Deletion neighbourhood: two strings within one edit have a variant in common
when each is taken whole and with every one of its characters deleted. Since
that makes as many variants as characters, lines are first cut into
``SEGMENTS`` parts: one edit lies in one part, so two such lines agree in all
text around it. The hash of what surrounds a part is a key; only parts whose
key occurs with two different lines emit variants, as hashed keys. Equal
variants are joined, the edit distance of the parts is verified, and the
earliest line stays.

Lines of slightly different length must cut alike, so the cuts follow from
the length rounded down to a multiple of about a sixteenth (its class); a
line at the start of its class takes part in the class below as well.

Lines are found a second time by a filter of ``FILTER_BITS`` bits over the
candidate keys, a table of fixed size that may be broadcast; it only saves
shuffling, candidates are joined by their full keys afterwards.

Other bounds than one edit take another way: ``k`` edits leave one of
``k + 1`` parts of the shorter line whole, so the lines that hold an equal
part at a place the edits allow are compared. Their number grows with the
square of the lines that share a part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import col, free_prefix
from ..session import materialize

SEGMENTS = 4
MIN_NEAR_CHARS = 10
#: Edits between two lines by the length they hold from; the shorter line decides.
BOUNDS = ((MIN_NEAR_CHARS, 1),)
FILTER_BITS = 1 << 23
HOT_ROWS, MAX_HOT = 1000, 100_000
_FILLED = r"CASE WHEN ascii(line) > 32 THEN true ELSE line RLIKE '[^\\x20\\x09-\\x0D]' END"


def _class(n: str) -> str:
    """SQL: length ``n`` rounded down to its class."""
    return f"({n} - {n} % shiftleft(1, greatest(length(bin({n})) - 5, 0)))"


_CLASSES = (f"IF(n > {MIN_NEAR_CHARS} AND {_class('n')} = n, array({_class('n')}, {_class('(n - 1)')}), "
            f"array({_class('n')}))")


def _part(j: int) -> str:
    """SQL: part ``j`` of a line cut by class ``c``, and the hash of the text around it."""
    start, rest = f"({j} * c) DIV {SEGMENTS}", f"c - ({j + 1} * c) DIV {SEGMENTS}"
    return (f"struct(xxhash64(c, {j}, left(line, CAST({start} AS INT)), right(line, CAST({rest} AS INT))) AS key, "
            f"substring(line, CAST({start} AS INT) + 1, CAST(n - {start} - ({rest}) AS INT)) AS part)")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with text: place (the order of lines), two hashes, length, the line."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("t"))
    src = src.select("id", F.xxhash64("id", "t").alias("rid"), F.posexplode(F.split("t", "\n", -1)).alias("no", "line"))
    place = F.struct(F.col("id").isNull().alias("nul"), F.col("id"), F.col("no"), F.col("rid"))
    return (src.where(F.expr(_FILLED))
            .select(place.alias("place"), F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"),
                    F.length("line").alias("n"), "line"))


def _exact(lines: DataFrame) -> DataFrame:
    """Places of lines that equal an earlier one.

    Lines that occur more than ``max(HOT_ROWS, repeated lines / MAX_HOT)`` times, at most ``MAX_HOT``
    of them, are told to every task; their rows are spread over the join with the others.
    """
    first = materialize(lines.groupBy("k1", "k2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("c"))
                        .where("c > 1").select(F.col("k1").alias("f1"), F.col("k2").alias("f2"), "first", "c"), "line-firsts")
    rows = first.agg(F.sum("c")).first()[0] or 0
    limit = max(HOT_ROWS, -(-rows // MAX_HOT))
    hot = first.where(F.col("c") > limit).select(F.col("f1").alias("h1"), F.col("f2").alias("h2"), F.col("first").alias("hot"))
    spread = (lines.select("k1", "k2", "place")
              .join(F.broadcast(hot), (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")), "left"))
    spread = spread.select(F.when(F.col("hot").isNull(), F.col("k1")).otherwise(F.floor(F.rand(5) * (1 << 40)).cast("long")).alias("k1"),
                           "k2", "place", "hot")
    rare = first.where(F.col("c") <= limit).drop("c")
    return (spread.join(rare, (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")), "left")
            .where(F.col("place") > F.coalesce("hot", "first")).select("place"))


def _near(lines: DataFrame, filter_bits: int) -> DataFrame:
    """First places of lines that are one edit from a line with an earlier first place."""
    parts = (lines.where(F.col("n") >= MIN_NEAR_CHARS)
             .select("*", F.explode(F.expr(_CLASSES)).alias("c"))
             .select("place", "k1", "k2", F.explode(F.array(*[F.expr(_part(j)) for j in range(SEGMENTS)])).alias("p"))
             .select("place", "k1", "k2", F.col("p.key").alias("key"), F.col("p.part").alias("part")))
    shared = materialize(parts.groupBy("key").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"))
                         .where("lo <> hi").select(F.col("key").alias("shared")), "line-keys")
    bit = F.pmod(F.col("shared"), F.lit(filter_bits))
    words = (shared.groupBy(F.floor(bit / 64).cast("int").alias("word"))
             .agg(F.expr(f"bit_or(shiftleft(1L, CAST(pmod(shared, {filter_bits}) % 64 AS INT)))").alias("bits")))
    place_bit = f"pmod(key, {filter_bits})"
    hit = (parts.join(F.broadcast(words), F.expr(f"CAST({place_bit} DIV 64 AS INT) = word"))
           .where(F.expr(f"shiftrightunsigned(bits, CAST({place_bit} % 64 AS INT)) & 1L = 1L"))
           .drop("word", "bits"))
    # a line that very many documents share is one row before the join
    cand = hit.groupBy("key", "k1", "k2").agg(F.min("place").alias("place"), F.first("part").alias("part"))
    cand = materialize(cand.join(shared, F.col("key") == F.col("shared")).drop("shared"), "line-candidates")
    # lines of m characters in their part, and lines one longer, meet under (key, m)
    sized = cand.select("*", F.length("part").alias("len")).select(
        "*", F.explode(F.expr("IF(len > 0, array(len, len - 1), array(len))")).alias("m"))
    sized = sized.select("*", (F.col("len") > F.col("m")).alias("longer"))
    pairs = (sized.groupBy("key", "m").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"), F.min("longer").alias("l"))
             .where("lo <> hi AND NOT l").select(F.col("key").alias("pk"), F.col("m").alias("pm")))
    sized = materialize(sized.join(pairs, (F.col("key") == F.col("pk")) & (F.col("m") == F.col("pm")))
                        .select(F.expr("xxhash64(key, m, k1, k2)").alias("cid"), "key", "m", "longer", "part", "place"),
                        "line-sized")
    # the part whole (tag -1, only if not longer) and with each character deleted (tag: where)
    variants = sized.select("cid", F.explode(F.expr("""
        concat(IF(longer, CAST(array() AS array<struct<v:bigint,tag:int>>), array(struct(xxhash64(key, m, part) AS v, -1 AS tag))),
               IF(length(part) = 0, CAST(array() AS array<struct<v:bigint,tag:int>>),
                  transform(sequence(0, length(part) - 1), i -> struct(
                    xxhash64(key, m, concat(left(part, i), substring(part, i + 2))) AS v, i AS tag))))""")).alias("x"))
    variants = variants.select("cid", F.col("x.v").alias("v"), F.col("x.tag").alias("tag"))
    equal = Window.partitionBy("v")
    met = (variants.select("*", F.min("cid").over(equal).alias("lo"), F.max("cid").over(equal).alias("hi"))
           .where("lo <> hi").select(F.col("cid").alias("mcid"), "v", "tag"))
    met = met.join(sized, F.col("mcid") == F.col("cid")).select(
        "v", "tag", "longer", "place", "part", F.struct("place", "part").alias("who"))
    # Groups are small: lines that differ in one place only are no more than there are characters.
    same_place = Window.partitionBy("v", "longer", "tag")
    met = met.select(
        "*", F.min("who").over(same_place).alias("swapped"),
        F.min(F.when(F.col("tag") == -1, F.col("who"))).over(equal).alias("whole"),
        F.min(F.when(F.col("longer"), F.col("who"))).over(equal).alias("grown"))
    other = F.expr("CASE WHEN longer THEN whole WHEN tag = -1 THEN grown ELSE swapped END")
    return (met.select("place", "part", other.alias("other"))
            .where("other.place < place AND levenshtein(part, other.part, 1) >= 0").select("place"))


def _near_within(lines: DataFrame, bounds: tuple[tuple[int, int], ...]) -> DataFrame:
    """First places of lines within ``bounds`` of a line with an earlier first place."""
    low, most = min(n for n, _ in bounds), max(k for _, k in bounds)

    def bound(n: str) -> str:
        whens = " ".join(f"WHEN {n} >= {at} THEN {k}" for at, k in sorted(bounds, reverse=True))
        return f"CASE {whens} ELSE 0 END"

    def part(n: str, k: str, shift: str) -> str:
        """SQL: key of part ``i`` of ``k + 1`` of a line of ``n`` characters, looked up ``shift`` further on."""
        start, end = f"(i * {n}) DIV ({k} + 1)", f"((i + 1) * {n}) DIV ({k} + 1)"
        return (f"xxhash64({n}, i, substring(line, CAST({start} + {shift} AS INT) + 1, CAST({end} - {start} AS INT)))")

    first = (lines.where(F.col("n") >= low).groupBy("k1", "k2")
             .agg(F.min("place").alias("place"), F.first("n").alias("n"), F.first("line").alias("line"))
             .select(F.xxhash64("k1", "k2").alias("cid"), "place", "n", "line"))
    first = materialize(first, "line-first")
    # before a whole part i lie at most i edits, behind it at most k - i, if no part before it is as well placed
    places = (f"filter(sequence(-i, i), d -> abs(d - (n - l)) <= k - i AND (i * l) DIV (k + 1) + d >= 0 "
              "AND ((i + 1) * l) DIV (k + 1) + d <= n)")
    longer = (f"flatten(transform(filter(sequence(greatest(n - {most}, {low}), n), l -> n - l <= {bound('l')}), "
              f"l -> transform(array({bound('l')}), k -> flatten(transform(sequence(0, k), "
              f"i -> transform({places}, d -> {part('l', 'k', 'd')}))))[0]))")
    shorter = f"transform(array({bound('n')}), k -> transform(sequence(0, k), i -> {part('n', 'k', '0')}))[0]"
    left = first.select(F.col("cid").alias("a"), F.explode(F.array_distinct(F.expr(shorter))).alias("key"))
    right = first.select(F.col("cid").alias("b"), F.explode(F.array_distinct(F.expr(longer))).alias("bkey"))
    pairs = (left.join(right, (F.col("key") == F.col("bkey")) & (F.col("a") != F.col("b"))).select("a", "b").distinct())
    pairs = materialize(pairs, "line-pairs")
    one, two = [first.select(*[F.col(c).alias(f"{s}_{c}") for c in first.columns]) for s in ("a", "b")]
    met = (pairs.join(one, F.col("a") == F.col("a_cid")).join(two, F.col("b") == F.col("b_cid"))
           .where(F.expr(f"levenshtein(a_line, b_line, {bound('a_n')}) >= 0")))
    return met.select(F.expr("IF(a_place < b_place, b_place, a_place)").alias("place")).distinct()


def repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", near: bool = True,
                   bounds: tuple[tuple[int, int], ...] = BOUNDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``place`` (nul, id, no, rid) of every line that repeats an earlier one; ``no`` counts from 0.

    Lines are what stands between line feeds, blank ones aside. Earlier means
    a smaller id (null ids last), or a smaller line number in the same
    document. A line repeats if it equals an earlier line or is near a line
    whose first place is earlier. Near means at most as many character
    insertions, deletions and replacements as ``bounds``, pairs of (from this
    many characters, so many edits), allows for the shorter of the two; one
    from ``MIN_NEAR_CHARS`` characters on unless given.
    """
    bounds = tuple((n, k) for n, k in bounds)
    if any(n < 1 or k < 0 for n, k in bounds):
        raise ValueError(f"bounds need lengths from 1 and edits from 0: {bounds}")
    lines = _lines(docs, id_col, text_col)
    found = _exact(lines)
    if not near or not any(k for _, k in bounds):
        return found
    return found.unionAll(_near(lines, filter_bits) if bounds == BOUNDS else _near_within(lines, bounds))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", counts: bool = True,
                **kw) -> DataFrame:
    """``docs`` with repeated lines cut out of the text, plus ``n_lines`` and ``n_removed`` (long).

    ``n_lines`` counts lines with text. Blank lines stay. Null texts count as
    empty and stay null; rows that repeat id and text are one document, and
    both keep the same lines. A document whose lines all repeat keeps an
    empty text. Columns named ``n_lines`` or ``n_removed`` are replaced;
    others stay. Without ``counts`` the two are not added and every column
    stays. An empty table gives an empty result.
    """
    place = repeated_lines(docs, id_col=id_col, text_col=text_col, **kw)
    p = free_prefix(docs.columns)
    gone = (place.select("place.*").groupBy("id", "rid").agg(F.collect_set("no").alias(p + "gone"))
            .select(F.col("id").alias(p + "id"), F.col("rid").alias(p + "rid"), p + "gone"))
    gone = materialize(gone, "repeated-lines")
    docs = docs.drop("n_lines", "n_removed") if counts else docs
    text = col(text_col)
    rid = F.xxhash64(col(id_col), F.coalesce(text, F.lit("")))
    out = docs.join(gone, (rid == F.col(p + "rid")) & col(id_col).eqNullSafe(F.col(p + "id")), "left")
    split = f"split(`{text_col}`, '\\n', -1)"
    kept = F.expr(f"transform(array({split}), ls -> array_join(transform("
                  f"array_except(sequence(0, size(ls) - 1), `{p}gone`), i -> element_at(ls, i + 1)), '\\n'))[0]")
    new = F.when(F.col(p + "gone").isNull(), text).otherwise(kept)
    columns = [new.alias(c) if c == text_col else col(c) for c in docs.columns]
    if not counts:
        return out.select(*columns)
    n_lines = F.expr(f"CAST(coalesce(size(filter({split}, line -> {_FILLED})), 0) AS BIGINT)")
    n_lines = F.when(text.isNull(), F.lit(0).cast("long")).otherwise(n_lines)
    return out.select(*columns, n_lines.alias("n_lines"),
                      F.when(F.col(p + "gone").isNull(), 0).otherwise(F.size(p + "gone")).cast("long").alias("n_removed"))
