"""Spelling variants: words one edit apart, found by pivotal grams, grouped under the commonest.

Bigrams are ordered by how many words hold them, rare ones first. A word's
prefix is its three first bigrams in that order, with all that tie with the
third. Two of them that share no character are its pivots, chosen by dynamic
programming so that as few words as possible hold them; of any three bigrams
two lie apart, so there always are two. One edit touches at most one of two
disjoint bigrams, so the other stands in the near word as well, and as it
comes no later in the order than either word's last prefix bigram, it is in
that word's prefix: the pivots of the word whose prefix ends first are looked
up in the prefixes of the others.

Position limits: one edit moves a bigram by one place at most. It lies on one
side of the pivot, so the whole other side stands in both words, at the same
distance from its end of the word. Where that side is shorter than half the
word, the side with the edit is halved once more, and one of its halves is
whole too. The hash of what is whole, with the length of the word that looks
up, is the key of the index, so a key holds half a word at least and few
candidates meet by chance. They are verified by their edit distance.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: The letters of a run: at most 90 differ once A-Z are lower-cased, so there are at most 8,100 bigrams.
LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
PREFIX = 3  # bigrams: one edit touches two, and one must be left over
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """``id`` and ``run``: every maximal run of letters of at least ``min_chars``, A-Z lower-cased."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"),
                      F.explode(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"[{LETTERS}]+"), F.lit(0))).alias("r"))
    return src.where(F.length("r") >= min_chars).select("id", F.translate("r", _UPPER, _LOWER).alias("run"))


def vocabulary(words: DataFrame, *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and its number of rows ``n``, of those with enough characters and rows."""
    return (words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def gram_ranks(vocab: DataFrame) -> dict[str, int]:
    """Each bigram's place in the order: by the number of words that hold it, then by itself.

    One entry per bigram of the alphabet (8,100 of :data:`LETTERS`), however many words there are.
    """
    grams = F.expr("array_distinct(transform(sequence(1, length(word) - 1), i -> substring(word, i, 2)))")
    counts = vocab.where("length(word) > 1").select(F.explode(grams).alias("gram")).groupBy("gram").count().collect()
    return {r.gram: k for k, r in enumerate(sorted(counts, key=lambda r: (r["count"], r.gram)))}


def prefix_grams(word: str, rank: dict[str, int]) -> tuple[list[int], int]:
    """Places of the prefix bigrams, ascending, and the rank of the last one in the order."""
    ranks = [rank[word[i:i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[PREFIX - 1]
    return [i for i, r in enumerate(ranks) if r <= last], last


def pivots(word: str, places: list[int], rank: dict[str, int]) -> tuple[int, int]:
    """The two disjoint prefix bigrams of least total rank.

    Dynamic programming over the places from left to right: the best single
    bigram that ends before a place is all that a second one needs to know.
    """
    best = None  # (cost, first, second)
    single = None  # cheapest (cost, place) among the bigrams at most at place - 2
    waiting = []
    for p in places:
        cost = rank[word[p:p + 2]]
        while waiting and waiting[0][1] <= p - 2:
            single = min(single, waiting.pop(0)) if single else waiting.pop(0)
        if single and (best is None or single[0] + cost < best[0]):
            best = (single[0] + cost, single[1], p)
        waiting.append((cost, p))
    return best[1], best[2]


def keys(word: str, place: int, length: int) -> list[str]:
    """What is whole beside an edit, as text, if the bigram at ``place`` of ``word`` is a pivot of a
    word of ``length`` characters one edit away."""
    out = []
    n, half = len(word), length / 2
    rest = length - place - 2  # edit behind the pivot, which stands at the same place
    if rest >= 0:
        whole = word[:place + 2]
        if len(whole) >= half or rest < 2:
            out.append(f"a {length} {whole}")
        else:
            out += [f"b {length} {word[:place + 2 + rest - rest // 2]}", f"c {length} {whole} {word[n - rest // 2:]}"]
    rest = place + length - n  # edit before the pivot, which stands as far from the end
    if rest >= 0:
        whole = word[place:]
        if len(whole) >= half or rest < 2:
            out.append(f"d {length} {whole}")
        else:
            out += [f"e {length} {word[n - length + rest // 2:]}", f"f {length} {word[:rest // 2]} {whole}"]
    return out


def _index(rank: dict[str, int]):
    names = ["key", "last", "pivot", "word", "n"]

    def rows(batches):
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            found, lasts, flags, at = [], [], [], []
            for k, word in enumerate(batch.column("word").to_pylist()):
                places, last = prefix_grams(word, rank)
                chosen = pivots(word, places, rank)
                n = len(word)
                for p in places:
                    for length in (n - 1, n, n + 1):
                        got = keys(word, p, length)
                        found += [digest(x.encode()) for x in got]
                        flags += [length == n and p in chosen] * len(got)
                        lasts += [last] * len(got)
                        at += [k] * len(got)
            took = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.uint64()).view(pa.int64()), pa.array(lasts, pa.int32()), pa.array(flags, pa.bool_()),
                 batch.column("word").take(took), batch.column("n").take(took)], names=names)
    return rows


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(a, an, b, bn): both directions of every pair of words one edit apart, each once.

    ``vocab`` has ``word`` (at least four characters each, without repeats) and ``n``.
    """
    index = materialize(vocab.select("word", "n").mapInArrow(
        _index(gram_ranks(vocab)), "key bigint, last int, pivot boolean, word string, n bigint"), "spelling-index")
    probe = index.where("pivot").select("key", F.col("last").alias("al"), F.col("word").alias("a"), F.col("n").alias("an"))
    other = index.select(F.col("key").alias("k"), F.col("last").alias("bl"), F.col("word").alias("b"), F.col("n").alias("bn"))
    met = probe.join(other, F.expr("key = k AND al <= bl AND a <> b AND levenshtein(a, b, 1) = 1"))
    both = F.expr("array(struct(a, an, b, bn), struct(b AS a, bn AS an, a AS b, an AS bn))")
    return met.select(F.explode(both).alias("x")).select("x.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) with the last word that following ``form`` reaches, as ``root``.

    Pointer doubling: a form is at least ``RATIO`` times as frequent, so chains are as long as the
    logarithm of the largest count at most, and the rounds its logarithm.
    """
    state = materialize(forms.select("word", "form", F.col("form").alias("root")), "spelling-forms")
    while True:
        ahead = state.select(F.col("word").alias("w"), F.col("root").alias("next"))
        state = materialize(state.join(ahead, F.col("root") == F.col("w"), "left")
                            .select("word", "form", F.coalesce("next", "root").alias("root"),
                                    F.col("next").isNotNull().alias("moved")), "spelling-forms")
        if not state.where("moved").take(1):
            return state.select("word", "form", "root")
        state = state.drop("moved")


def group_variants(vocab: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of ``vocab`` (``word``, ``n``).

    Words are near if they differ by one inserted, deleted or replaced
    character. A word's form is its near word of largest ``n`` (ties: the
    smallest), if that is at least ``ratio`` times its own; else null. The
    root is what following forms ends at, the word itself without one.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    vocab = materialize(vocab, "spelling-words")
    best = F.min(F.struct((-F.col("bn")).alias("m"), F.col("b").alias("form")))
    near = near_pairs(vocab).groupBy("a", "an").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = F.expr(f"-best.m >= {ratio} * an")
    near = materialize(near.select("a", "n_near", F.when(is_form, F.col("best.form")).alias("form"),
                                   F.when(is_form, -F.col("best.m")).alias("form_n")), "spelling-near")
    ends = roots(near.where("form IS NOT NULL").select(F.col("a").alias("word"), "form"))
    ends = ends.select(F.col("word").alias("r_word"), "root")
    return (vocab.join(near, F.col("word") == F.col("a"), "left").join(ends, F.col("word") == F.col("r_word"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                      min_count: int = MIN_COUNT, ratio: int = RATIO, words: DataFrame | None = None) -> DataFrame:
    """Variants among the words of ``docs``, as :func:`group_variants` returns them.

    Words are the maximal runs of ``LETTERS``, A-Z lower-cased, of at least
    ``min_chars`` (4 or more) characters that occur ``min_count`` times in
    all; ``words`` (a column ``word``) replaces them. Null and empty texts
    have no words; ids, null or repeated, play no part; every row counts.
    Other columns are ignored, whatever their names. An empty table gives an
    empty result.
    """
    if min_chars < PREFIX + 1:
        raise ValueError(f"three bigrams need words of {PREFIX + 1} characters")
    if words is None:
        words = runs(docs, id_col=id_col, text_col=text_col, min_chars=min_chars).select(F.col("run").alias("word"))
    return group_variants(vocabulary(words, min_chars=min_chars, min_count=min_count), ratio=ratio)


def with_slips(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               every: int = 199) -> DataFrame:
    """``word``: the runs of ``docs`` with one character deleted from some, to have misspellings to find.

    With ``h`` the crc32 of ``<id>:<run>`` (a null id is empty), a run whose ``h`` is a multiple of
    ``every`` loses its character number ``h`` modulo its length, from 0.
    """
    found = runs(docs, id_col=id_col, text_col=text_col, min_chars=min_chars)
    named = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    found = found.select("run", F.crc32(F.encode(named, "UTF-8")).alias("h"))
    cut = F.expr(f"CASE WHEN h % {every} = 0 THEN concat(left(run, CAST(h % length(run) AS INT)), "
                 "substring(run, CAST(h % length(run) AS INT) + 2)) ELSE run END")
    return found.select(cut.alias("word"))
