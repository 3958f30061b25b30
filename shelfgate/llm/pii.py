r"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

DataFrame functions only. Positions come from the text between the matches:
``split`` gives the gaps and ``regexp_extract_all`` the matches of one
pattern, so a match starts at the sum of the lengths before it. Positions are
code points, end exclusive.

The patterns are written so that Java's matcher needs linear time and no
recursion on very long texts (no repeated groups of varying length); each
accepts exactly the leftmost non-overlapping matches of the plain form given
beside it. The IBAN pattern takes in only the first four characters and looks
ahead for the rest, so every place where one could start is tried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schema import col, free_prefix

BLOCK = 256


@dataclass(frozen=True)
class Kind:
    """One kind of span. ``valid`` is SQL over ``v`` (the matched text); ``score`` is that of a
    confirmed span, raised by ``boost`` if one of the ``context`` words is nearby. The span is
    ``group`` of the pattern and starts where the match does. ``base`` kinds are reported
    whatever their score."""

    name: str
    probe: str
    pattern: str
    valid: str
    base: bool = True
    score: float = 1.0
    boost: float = 0.0
    context: tuple[str, ...] = ()
    group: int = 0


_DIGITS = "regexp_replace(v, '[^0-9]', '')"
_LUHN = (f"aggregate(transform(split(reverse({_DIGITS}), ''), (d, i) -> IF(i % 2 = 0, CAST(d AS INT), "
         "IF(CAST(d AS INT) > 4, 2 * CAST(d AS INT) - 9, 2 * CAST(d AS INT)))), 0, (a, d) -> a + d) % 10 = 0")
# ISO 13616: the first four characters go last, letters count 10 to 35, the number modulo 97 is 1.
_IBAN = "replace(v, ' ', '')"
_MOD97 = (f"aggregate(split(concat(substring({_IBAN}, 5), left({_IBAN}, 4)), ''), 0, (a, c) -> "
          "IF(c >= '0' AND c <= '9', (a * 10 + CAST(try_cast(c AS INT) AS INT)) % 97, "
          "(a * 100 + ascii(c) - 55) % 97)) = 1")

# Characters of an IBAN by country: the ISO 13616 register and the countries that use one without being in it.
IBAN_CHARS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
              21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
              24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
              27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
              28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
              30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_KNOWN = "|".join(" ".join(IBAN_CHARS.values()).split())
# other codes: the whole run
_IBAN_RUN = "|".join([rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_CHARS.items()]
                     + [rf"(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+"])

_PHONE_WORDS = ("tel", "phone", "telephone", "mobile", "cell", "call", "fax", "telefon", "handy", "portable")
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", "@",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
         r"(?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])*+", "true", score=0.9, boost=0.1,
         context=("mail", "email", "e-mail", "contact", "courriel", "correo")),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind("ip", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
         r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         "forall(split(v, '[.]'), p -> length(ltrim('0', p)) <= 3 AND "
         "CAST(concat('0', left(ltrim('0', p), 3)) AS INT) <= 255)", score=0.5, boost=0.4,
         context=("ip", "host", "server", "client", "address", "login")),
    # [0-9]([\x20-]?[0-9])+, 16 to 19 digits passing Luhn
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){15}",
         r"[0-9](?=[\x20-]?[0-9])(?:(?![\x20-](?![0-9]))[0-9\x20-])*+",
         f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}", score=0.7, boost=0.3,
         context=("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta")),
    # \+[0-9][\x20().0-9-]+[0-9], 8 to 15 digits
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15", score=0.6,
         boost=0.3, context=_PHONE_WORDS),
    Kind("iban", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]",
         rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=({_IBAN_RUN})(?![A-Za-z0-9]))[A-Z]{{2}}[0-9]{{2}}",
         f"length({_IBAN}) BETWEEN 15 AND 34 AND {_MOD97}", base=False, score=0.7, boost=0.3,
         context=("iban", "account", "bank", "konto", "cuenta", "compte"), group=1),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         "left(v, 3) NOT IN ('000', '666') AND left(v, 1) <> '9' AND substring(v, 5, 2) <> '00' "
         "AND right(v, 4) <> '0000'", base=False, score=0.3, boost=0.4,
         context=("ssn", "social security", "taxpayer")),
    # numbers that say little alone: only a word beside them makes them personal
    Kind("local_phone", r"[0-9]{3}[\x20./-][0-9]",
         r"(?<![A-Za-z0-9+.-])\(?[0-9]{2,5}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![A-Za-z0-9-]|\.[0-9])",
         f"length({_DIGITS}) BETWEEN 8 AND 13", base=False, score=0.2, boost=0.4, context=_PHONE_WORDS),
    Kind("account", r"[0-9]{8}", r"(?<![A-Za-z0-9.,-])[0-9]{8,12}(?![A-Za-z0-9-]|[.,][0-9])", "true", base=False,
         score=0.2, boost=0.4, context=("account", "acct", "konto", "kontonummer", "compte", "cuenta")),
)
THRESHOLD = 0.5
CONTEXT_CHARS = 40


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _running(lengths: str) -> str:
    """SQL: running sums of an array, ``BLOCK`` at a time (appending costs a copy)."""
    inner = ("aggregate(slice({l}, j * {b} + 1, {b}), struct(s.off AS off, CAST(array() AS array<bigint>) AS o), "
             "(a, x) -> struct(a.off + x AS off, concat(a.o, array(a.off + x)) AS o))")
    inner = inner.format(l="ls", b=BLOCK)
    return (f"transform(array({lengths}), ls -> aggregate(sequence(0, CAST((size(ls) - 1) DIV {BLOCK} AS INT)), "
            "struct(CAST(0 AS BIGINT) AS off, CAST(array() AS array<array<bigint>>) AS o), "
            f"(s, j) -> transform(array({inner}), r -> struct(r.off AS off, concat(s.o, array(r.o)) AS o))[0], "
            "s -> flatten(s.o)))[0]")


_EMPTY = "CAST(array() AS array<struct<kind:string,k:int,start:bigint,end:bigint,score:double>>)"


def _spans(kind: Kind, k: int) -> str:
    """SQL: the confirmed spans of one kind in ``_t``."""
    pat = _sql(kind.pattern)
    probe = "contains(_t, '@')" if kind.probe == "@" else f"_t RLIKE {_sql(kind.probe)}"
    near = "false"
    if kind.context:
        # only validated matches get here, so the two substrings are rare
        words = f"(?<![a-z])(?:{'|'.join(kind.context)})(?![a-z])"
        near = (f"lower(concat(substring(_t, CAST(greatest(e - length(v) - {CONTEXT_CHARS}, 0) AS INT) + 1, "
                f"CAST(least({CONTEXT_CHARS}, e - length(v)) AS INT)), ' ', "
                f"substring(_t, CAST(e AS INT) + 1, {CONTEXT_CHARS}))) RLIKE {_sql(words)}")
    score = f"CAST({kind.score} + IF({near}, {kind.boost}, 0) AS DOUBLE)"
    ends = _running("transform(m, (x, i) -> CAST(length(x) + length(element_at(g, i + 1)) AS BIGINT))")
    zipped = f"zip_with(m, {ends}, (v, e) -> struct(v AS v, e AS e))"
    if kind.group:  # from the match's start to the end of the group
        zipped = (f"zip_with({zipped}, regexp_extract_all(_t, {pat}, {kind.group}), "
                  "(x, v) -> struct(v AS v, x.e - length(x.v) + length(v) AS e))")
    # a validator is evaluated only where its pattern matched
    one = (f"transform(array(x.e), e -> transform(array(x.v), v -> IF({kind.valid}, "
           f"struct('{kind.name}' AS kind, {k} AS k, e - length(v) AS start, e AS end, {score} AS score), null))[0])[0]")
    found = (f"transform(array(regexp_extract_all(_t, {pat}, 0)), m -> IF(size(m) = 0, {_EMPTY}, "
             f"transform(array(split(_t, {pat}, -1)), g -> "
             f"filter(transform({zipped}, x -> {one}), s -> s IS NOT NULL))[0]))[0]")
    return f"CASE WHEN {probe} THEN {found} ELSE {_EMPTY} END"


def find_pii(docs: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD,
             kinds: tuple[Kind, ...] = KINDS, spans_col: str = "pii") -> DataFrame:
    """``docs`` plus ``spans_col``: array of (kind, k, start, end, score), by kind then start.

    A span is proposed by its kind's pattern and confirmed by its validator;
    failing matches are dropped without a retry. An IBAN has its country's
    length, so what follows it after a blank is not taken in, and one may start
    inside a match that failed. Kinds with ``base`` are
    always reported, others when their score, raised by a context word within
    40 characters, reaches ``threshold``. Null text counts as empty; a column
    named ``spans_col`` is replaced.
    """
    cols = [c for c in docs.columns if c != spans_col]
    # the given columns travel in one struct, so that none can have the name of a helper
    src = docs.select(F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(cols)]).alias("row"),
                      F.coalesce(col(text_col), F.lit("")).alias("_t"))
    parts = [f"_p{k}" for k in range(len(kinds))]
    src = src.select("*", *[F.expr(_spans(kind, k)).alias(p) for (k, kind), p in zip(enumerate(kinds), parts)])
    kept = [p if kind.base else f"filter({p}, s -> s.score >= {threshold})" for kind, p in zip(kinds, parts)]
    return src.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(cols)],
                      F.expr(f"concat({', '.join(kept)})").alias(spans_col))


def redact(docs: DataFrame, *, text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets, ``[EMAIL]``.

    Of overlapping spans the one that starts first gives the name, and the
    covered stretch is replaced as a whole. Texts without spans, and null
    texts, stay as they are. Columns and their order are unchanged.
    """
    spans = free_prefix(docs.columns) + "pii"
    found = find_pii(docs, text_col=text_col, spans_col=spans, **kw)
    merged = f"""
      aggregate(sort_array(transform(`{spans}`, s -> struct(s.start AS a, s.end AS b, s.kind AS kind))),
        CAST(array() AS array<struct<a:bigint,b:bigint,kind:string>>),
        (m, s) -> IF(size(m) > 0 AND s.a < element_at(m, -1).b,
                     concat(slice(m, 1, size(m) - 1),
                            array(struct(element_at(m, -1).a AS a, greatest(element_at(m, -1).b, s.b) AS b,
                                         element_at(m, -1).kind AS kind))),
                     concat(m, array(s))))"""
    # The text is cut BLOCK spans at a time: a cut by position costs what stands before it, so first the
    # stretch of a block of spans is cut out of the text, then the pieces between them out of the stretch.
    quoted = f"`{text_col}`"
    before = "IF(i = 0, 0L, element_at(m, CAST(greatest(i, 1) AS INT)).b)"
    piece = ("transform(slice(m, j * {n} + 1, {n}), (s, k) -> transform(array(j * {n} + k), i -> concat("
             "substring(part, CAST({before} - off AS INT) + 1, CAST(s.a - {before} AS INT)), '[', upper(s.kind), ']'))[0])")
    piece = piece.format(n=BLOCK, before=before)
    text = f"""
      transform(array({merged}), m -> concat(
        array_join(transform(sequence(0, CAST((size(m) - 1) DIV {BLOCK} AS INT)), j ->
          transform(array(transform(array(j * {BLOCK}), i -> {before})[0]), off ->
            transform(array(substring({quoted}, CAST(off AS INT) + 1,
                      CAST(element_at(m, CAST(least((j + 1) * {BLOCK}, size(m)) AS INT)).b - off AS INT))), part ->
              array_join({piece}, ''))[0])[0]), ''),
        substring({quoted}, CAST(element_at(m, -1).b AS INT) + 1)))[0]"""
    new = F.expr(f"CASE WHEN size(`{spans}`) > 0 THEN {text} ELSE {quoted} END")
    return found.select(*[new.alias(c) if c == text_col else col(c) for c in docs.columns])
