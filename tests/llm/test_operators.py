"""The operators against plain Python on the smallest tables and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from shelfgate.llm import bpe, exact, html, lines, packing, pii, quality, simhash, substrings, warc
from shelfgate.llm.queries import tokenizer_path
from shelfgate.session import materialize

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
# nulls, empty and blank texts, one very long text, equal texts, a repeated row, odd characters
ODD = [(0, None), (1, ""), (2, " \n\t "), (3, "a b c"), (4, LONG), (5, "a b c"), (5, "a b c"), (None, "a b c"),
       (None, None), (6, "Straße ÉCOLE   ﬁ 😀😀 <|endoftext|> it's é x≠ 1,000.5!?"), (7, LONG + " tail"),
       (8, "mail a.b@c.de, +49 (30) 1234-5678 10.0.0.255 4111 1111 1111 1111\n" * 3)]
SCHEMA = "doc_id long, text string, lang string, id string, kept string, block string, place string, n_lines string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "xx", "id", "kept", "b", "p", "n") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def words(text):
    return WORD.findall(text or "")


def multiset(found):
    return sorted(found, key=repr)


# ---- 1 BPE

def brute_bpe(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.no_padding()
    t.no_truncation()
    out = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((i, np.asarray(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)))
    return out


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_bpe_equals_the_library(request, rows, which):
    df = request.getfixturevalue(which)
    got = bpe.decode(bpe.encode(df, tokenizer_path(), block_bytes=50_000), tokenizer_path())
    expected = brute_bpe(rows if which == "docs" else ODD)
    assert multiset((r[0], bytes(r[1]), r[2]) for r in got.collect()) == multiset(expected)


# ---- 2 line dedup

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute_lines(rows):
    first, places = {}, []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        for n, line in enumerate((t or "").split("\n")):
            if words(line):
                places.append((i, n, line))
                first.setdefault(line, len(places))
    near = {a for a in first for b in first if first[b] < first[a] and min(len(a), len(b)) >= lines.MIN_NEAR_CHARS
            and one_edit(a, b)}
    seen, gone = set(), set()
    for i, n, line in places:
        if line in seen or line in near:
            gone.add((i, n))
        seen.add(line)
    return gone


def edited(rng, line):
    at, kind, c = rng.randrange(len(line)), rng.random(), rng.choice("abxé😀l")
    return line[:at] + line[at + 1:] if kind < .3 else line[:at] + c + line[at:] if kind < .6 else line[:at] + c + line[at + 1:]


def test_lines_equal_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abl é") for _ in range(n)) for n in (5, 9, 10, 11, 12, 19, 20, 21, 31, 32, 33, 63, 64, 65, 127, 128, 129, 300)]
    made = []
    for i in range(80):
        some = [rng.choice(base) for _ in range(rng.randrange(6))]
        some = [edited(rng, s) if rng.random() < .6 else s for s in some]
        made.append((i, "\n".join(edited(rng, s) if rng.random() < .3 else s for s in some) if i % 17 else None))
    df = spark.createDataFrame(made, "doc_id long, text string")
    gone = brute_lines(made)
    assert {(r.id, r.no) for r in lines.repeated_lines(df).select("place.*").collect()} == gone
    # a filter that lets everything pass changes nothing
    assert {(r.id, r.no) for r in lines.repeated_lines(df, filter_bits=64).select("place.*").collect()} == gone
    for r in lines.dedup_lines(df).collect():
        text = dict(made)[r.doc_id]
        assert r.text == (None if text is None else
                          "\n".join(x for n, x in enumerate(text.split("\n")) if (r.doc_id, n) not in gone))


def test_a_very_common_line_is_removed_alike(spark, monkeypatch):
    rng = random.Random(9)
    made = [(i, "\n".join(rng.choice(["the common line of all", f"own line number {i} here", "another shared line", "the common line of oll"])
                          for _ in range(4))) for i in range(60)]
    gone = brute_lines(made)
    monkeypatch.setattr(lines, "HOT_ROWS", 3)
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert {(r.id, r.no) for r in lines.repeated_lines(df).select("place.*").collect()} == gone


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return row[-1]


def test_lines_within_wider_bounds_equal_brute_force(spark):
    rng = random.Random(5)
    bounds = ((2, 1), (15, 2), (40, 3))
    base = ["".join(rng.choice("abl é") for _ in range(n)) for n in (2, 3, 5, 9, 14, 15, 16, 24, 39, 40, 41, 42, 64, 90)]
    made = []
    for i in range(40):
        some = [rng.choice(base) for _ in range(4)]
        for _ in range(4):
            some = [edited(rng, s) if s and rng.random() < .45 else s for s in some]
        made.append((i, "\n".join(some)))
    places = [(i, n, line) for i, t in made for n, line in enumerate(t.split("\n")) if words(line)]
    first = {}
    for at, (_, _, line) in enumerate(places):
        first.setdefault(line, at)

    def near(a, b):
        n = min(len(a), len(b))
        return edits(a, b) <= max([k for at, k in bounds if n >= at], default=0)
    gone = {(i, n) for at, (i, n, line) in enumerate(places)
            if first[line] < at or any(first[b] < at and near(line, b) for b in first)}
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert {(r.id, r.no) for r in lines.repeated_lines(df, bounds=bounds).select("place.*").collect()} == gone
    kept = {r.doc_id: r.text for r in lines.dedup_lines(df, bounds=bounds).collect()}
    assert kept == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in made}
    # one edit by the general way is one edit by the default one
    plain, general = [{(r.id, r.no) for r in lines.repeated_lines(df, bounds=b).select("place.*").collect()}
                      for b in (lines.BOUNDS, (*lines.BOUNDS, (10_000, 1)))]
    assert plain == general and len(plain) < len(gone)
    licence = "Copyright 2021 " + "all rights reserved by the owners, " * 8
    df = spark.createDataFrame([(1, licence + "\nHome 1"), (2, licence.replace("2021", "2034") + "\nHome 2")], "doc_id long, text string")
    assert lines.dedup_lines(df, bounds=((4, 1), (40, 2))).where("doc_id = 2").first().n_removed == 2


def test_lines_odd_rows(odd, empty):
    got = lines.dedup_lines(odd)
    assert got.columns == [c for c in odd.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    found = {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()}
    assert (0, None, 0, 0) in found and (1, "", 0, 0) in found and (2, " \n\t ", 0, 0) in found
    assert (3, "a b c", 1, 0) in found and (5, "", 1, 1) in found and (None, "", 1, 1) in found
    assert got.count() == len(ODD) and lines.dedup_lines(empty).count() == 0


# ---- 3 SimHash

def brute_fingerprint(text):
    ws = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[k:k + 4]).encode(), 42) for k in range(max(1, len(ws) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fp = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return [(i, fp[k], low.get(find(k))) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_simhash_equals_brute_force(request, rows, which):
    got = simhash.near_dedup(request.getfixturevalue(which)).collect()
    expected = brute_components(rows if which == "docs" else ODD)
    assert multiset((r[0], r[1] & (2**64 - 1), r[2]) for r in got) == multiset(expected)


def test_simhash_empty_and_keep_one(docs, rows, empty):
    assert simhash.near_dedup(empty).count() == 0
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == {i for i, _, c in brute_components(rows) if i == c}


def test_fuzzy_keys_meet_within_four_bits():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 1000, dtype=np.uint64)
    y = x.copy()
    for k in range(4):  # up to four bits, half of them close together
        y ^= np.uint64(1) << (rng.integers(0, 64, 1000, dtype=np.uint64) if k < 2 else rng.integers(0, 22, 1000, dtype=np.uint64))
    sets = []
    for v in (x, y):
        at, keys = simhash.fuzzy_keys(v)
        sets.append([set(keys[at == k].tolist()) for k in range(len(v))])
    assert all(a & b for a, b in zip(*sets))


def test_links_in_tiles_connect_the_same(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**64, 3, dtype=np.uint64)
    near = [int(s) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for s in seeds for k in (0, 1, 2, 3, 4) for _ in range(8)]
    fps = sorted({int(np.uint64(f).astype(np.int64)) for f in near})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    whole = {r.node: r.root for r in simhash.linked_components(df).collect()}
    tiled = {r.node: r.root for r in simhash.linked_components(df, tile=4).collect()}
    assert whole == tiled and len(set(whole.values())) == 3


# ---- 4 substring dedup

def brute_repeats(rows, n=20):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            key = tuple(w[s:s + n])
            if key in seen:
                gone[s:s + n] = [True] * n
            seen.add(key)
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("base", [5, 10])
def test_repeats_equal_brute_force(docs, rows, base):
    got = substrings.remove_repeats(docs, base_words=base, block_bytes=40_000).collect()
    assert multiset(map(tuple, got)) == multiset(brute_repeats(rows))


def test_windows_that_share_one_hash_are_told_apart(docs, rows, monkeypatch):
    h, h2 = (np.array(x, np.uint64) for x in ([5, 5, 7, 5, 7, 5], [1, 2, 3, 1, 3, 2]))
    assert substrings._first_of_equals(h, h2).tolist() == [0, 1, 2, 0, 2, 1]
    import pyarrow as pa

    found = pa.table({"h": pa.array([5, 9, 5], pa.int64()), "h2": pa.array([2, 3, 4], pa.int64())})
    assert substrings._among(h, h2, found).tolist() == [False, True, False, False, False, True]


def test_repeats_odd_rows(odd, empty):
    found = {(r[0], r[1], r[2]) for r in substrings.remove_repeats(odd, block_bytes=1000).collect()}
    assert {(0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 3, 0), (None, 3, 0)} <= found
    assert {f for f in found if f[0] in (4, 7)} == {(i, n, r) for i, n, r, _ in brute_repeats([(4, LONG), (7, LONG + " tail")])}
    assert substrings.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        substrings.remove_repeats(odd, min_words=25)


# ---- 5 HTML

def test_html_layout():
    page = """<html><head><title>no</title></head><body><h1>Head  line</h1><p>One<p>two <b>bold</b><br>next
<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul><table><tr><th>Name<th>Qty<tr><td>apple<td>1<tr><td colspan=2>wide</table>
<div>x<div>y</div></div><pre>a
  b</pre><p style="display:none">no<p hidden>no<p title=it's>1 < 2 &amp; <script>var t="</p>"</script>end"""
    assert html.page_text(page) == ("Head line\n\nOne\n\ntwo bold\nnext\n\n- a\n- b\n   3. x\n   4. y\n- c\n\n"
                                    "Name   Qty\napple  1\nwide\n\nx\ny\n\na\n  b\n\n1 < 2 & end")


def test_html_words_equal_a_plain_parser(spark):
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.skip, self.out = 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style", "title")
            if tag in html.BLOCK or tag == "br":
                self.out.append(" ")

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style", "title")
            if tag in html.BLOCK:
                self.out.append(" ")

        def handle_data(self, data):
            if not self.skip:
                self.out.append(data)

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    text = {r.page_id: r.text for r in html.extract_text(pages).collect()}
    for r in pages.collect():
        p = Plain()
        p.feed(r.html)
        assert [w for w in text[r.page_id].split() if w != "-"] == "".join(p.out).split()


def test_html_odd_pages(spark):
    odd = [(1, None), (2, ""), (None, "<p>x"), (3, "<div>" * 20_000 + "deep"), (4, "<" * 1000), (4, '<a b="'), (5, "</p></b>y")]
    df = spark.createDataFrame([(i, h, "t", "i") for i, h in odd], "page_id long, html string, text string, id string")
    found = multiset((r.page_id, r.text) for r in html.extract_text(df).collect())
    assert found == multiset([(1, ""), (2, ""), (None, "x"), (3, "deep"), (4, "<" * 1000), (4, ""), (5, "y")])
    assert html.extract_text(df.where("false")).count() == 0


def test_html_svg_and_math_end():
    for page, text in [('<p>a <svg class="i"/>b<p>c', "a b\n\nc"), ("a<svg><title/><path d='m0'/></svg> b", "a b"),
                       ("a<svg><style/><script/><g/></svg> b</title>", "a b"), ("<svg><g><path><p>b<div>c</div>d", "b\n\nc\nd"),
                       ("<math><mrow><mi/><table><tr><td>x<td>y</table>z", "x  y\n\nz"), ("<div><svg><g></div>a", "a"),
                       ("<svg><title>t<b>u</b></title></svg>a", "a"), ("<svg><style>a</style><title><![CDATA[>x]]></title></svg>b", "b"),
                       ("<svg><g></svg>a</g>b", "ab"), ("<svg></p>a", "a"), ("<p>a<svg:svg/>b<style/>c</style>d", "abd"),
                       ("<svg>" + "<g>" * 20_000 + "</x>" * 20_000 + "<p>deep", "deep")]:
        assert html.page_text(page) == text, page[:80]


def test_html_svg_and_math_text():
    for page, text in [("<p>Euler: <math><mi>e</mi><mo>=</mo><mn>2.7</mn><annotation>no</annotation></math>.", "Euler: e=2.7."),
                       ("<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>", "1 2"),
                       ("<svg>no<title>no</title><defs><text>no</text></defs><text>A</text><g><text>B<tspan>C</tspan></text></g></svg>x", "A BC x"),
                       ("<svg><text display='none'>no</text><g visibility='hidden'><text>no</text><text visibility='visible'>D</text></g></svg>", "D"),
                       ("<svg><text><tspan x='1'>a</tspan><tspan x='1'>b</tspan><a>c</a></text><a>no</a></svg>", "a b c"),
                       ("<svg><style>no</style><foreignObject><p>p<div>q</div></foreignObject><desc>no</desc></svg>r", "p\n\nq\nr"),
                       ("<table><tr><td><math><mtr><mtd>1</mtd><mtd>2</mtd></mtr></math><td>b</table>", "1 2  b")]:
        assert html.page_text(page) == text, page


# ---- 6 PII

def brute_pii(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        d = [int(c) for c in reversed(digits(s))]
        return sum(x if k % 2 == 0 else 2 * x - 9 * (2 * x > 9) for k, x in enumerate(d)) % 10 == 0
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(v)),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15)]
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]


PII_TEXTS = ["a@b.c-d@e.f.g x_a@b.co_m@q.de .@a.b. a@@b.c é😀a@b.cd", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.000255 1.2.3",
             "4111111111111111 4111 1111-1111 1111 2 5500 0000 0000 0004-1 4111--111111111111", "+1 (017) 555-7713 +1(((( +12 34 +1234567",
             "IBAN: DE89 3704 0044 0532 0130 00, SSN 123-45-6789 and 123-45-6789" + " " * 60 + "321-45-6789", "@" * 5000 + "a" * 100_000 + "@",
             "1" * 50_000 + " " + "1 " * 20_000, "a@a" + ".a" * 20_000, "x@y.zz " * 700, None, ""]


def test_pii_equals_brute_force(spark, docs, rows):
    both = rows + [(10_000 + k, t) for k, t in enumerate(PII_TEXTS)]
    df = docs.select("doc_id", "text").unionAll(spark.createDataFrame(both[len(rows):], "doc_id long, text string"))
    text = dict(both)
    n_base = sum(k.base for k in pii.KINDS)
    for r in pii.find_pii(df).collect():
        assert [(s.kind, s.start, s.end) for s in r.pii if s.k < n_base] == brute_pii(text[r.doc_id]), r.doc_id
        if r.doc_id == 10_004:
            extra = [((text[r.doc_id] or "")[s.start:s.end], round(s.score, 1)) for s in r.pii if s.k >= n_base]
            assert extra == [("DE89 3704 0044 0532 0130 00", 1.0), ("123-45-6789", 0.7), ("123-45-6789", 0.7)]


def test_iban_beside_words_and_numbers(spark):
    texts = {"DE89370400440532013000 Please": "DE89370400440532013000", "GB82WEST12345698765432 12 May": "GB82WEST12345698765432",
             "é😀 DE89 3704 0044 0532 0130 00 BIC X": "DE89 3704 0044 0532 0130 00", "NO9386011117947 A1": "NO9386011117947",
             "MT84MALT011000012345MTLCAST001S": "MT84MALT011000012345MTLCAST001S", "AB12 NO93 8601 1117 947 B": "NO93 8601 1117 947",
             "BE12 GB82 WEST 1234 5698 7654 32 AND": "GB82 WEST 1234 5698 7654 32", "DE89370400440532013001 Please": None,
             "XDE89370400440532013000": None, "DE893704004405320130007 Z": None}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.text: [r.text[s.start:s.end] for s in r.pii if s.kind == "iban"] for r in pii.find_pii(df).collect()}
    assert got == {t: [v] if v else [] for t, v in texts.items()}
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert all(clean[i] == t.replace(v, "[IBAN]") for i, (t, v) in enumerate(texts.items()) if v)


def test_context_words_decide_and_grade(spark):
    texts = ["Tel. 030 123-4567", "room 030 123-4567", "hotel 030 123-4567", "account no 12345678", "order 12345678", "Konto: 0012345678",
             "contact a@b.cd", "x a@b.cd", "login from 10.0.0.1", "v 10.0.0.1", "credit card 4111111111111111", "4111111111111111"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, r.text[s.start:s.end], round(s.score, 2)) for s in r.pii] for r in pii.find_pii(df).collect()}
    assert got == {0: [("local_phone", "030 123-4567", 0.6)], 1: [], 2: [], 3: [("account", "12345678", 0.6)], 4: [],
                   5: [("account", "0012345678", 0.6)], 6: [("email", "a@b.cd", 1.0)], 7: [("email", "a@b.cd", 0.9)],
                   8: [("ip", "10.0.0.1", 0.9)], 9: [("ip", "10.0.0.1", 0.5)], 10: [("card", "4" + "1" * 15, 1.0)],
                   11: [("card", "4" + "1" * 15, 0.7)]}
    weak = pii.find_pii(df, threshold=0.1).collect()
    assert sum(len(r.pii) for r in weak) == 12 and {r.pii[0].score for r in weak if r.doc_id in (1, 2, 4)} == {0.2}


def test_redact(odd, empty):
    got = pii.redact(odd)
    assert got.columns == odd.columns
    text = [r.text for r in got.where("doc_id = 8").collect()]
    assert text == ["mail [EMAIL], [PHONE] [IP] [CARD]\n" * 3] or "[EMAIL]" in text[0] and "@" not in text[0]
    assert multiset(r.text for r in got.where("doc_id < 4").collect()) == multiset(t for i, t in ODD if i in (0, 1, 2, 3))
    assert pii.redact(empty).count() == 0


# ---- 7 WARC

def test_warc_round_trip(spark):
    made = [(1, "http://a/1", "<p>é"), (2, "http://a/2", "<p>é"), (3, None, None), (4, "http://a/4\r\nX: y", ""),
            (5, "u", "<p>other"), (6, "u", "<p>é"), (None, "n", "<p>é"), (None, "n", "alone"), (None, "n", "alone"), (7, "x", "\r\n\r\n" * 9)]
    df = spark.createDataFrame([(*r, "e", 1) for r in made], "page_id long, url string, html string, sha string, n int")
    index, folder = warc.write_archives(df)
    got = warc.read_records(index, folder).collect()
    assert len(got) == len(made)
    by = {r.page_id: r for r in got if r.page_id is not None}
    assert (by[6].record_type, by[6].refers_to, bytes(by[6].payload)) == ("response", None, "<p>é".encode())
    for i in (1, 2):
        assert (by[i].record_type, by[i].refers_to, by[i].payload_bytes, by[i].payload) == ("revisit", 6, 5, None)
    assert by[3].record_type == "revisit" and by[3].refers_to == 4 and by[4].payload_bytes == 0
    assert bytes(by[7].payload) == b"\r\n\r\n" * 9 and by[4].url == "http://a/4\r\nX: y" and by[3].url is None
    assert sorted(r.record_type for r in got if r.page_id is None) == ["response", "response", "revisit"]
    some = warc.read_records(index.where("page_id in (5, 7)"), folder, with_payload=False)
    assert sorted(r.page_id for r in some.collect()) == [5, 7]
    kept, folder = warc.write_archives(df, min_bytes=1)
    assert {r.record_type for r in warc.read_records(kept, folder).where("page_id in (3, 4)").collect()} == {"response"}
    none, folder = warc.write_archives(df.where("false"))
    assert warc.read_records(none, folder).count() == 0


def test_warc_ids_and_urls_come_back_as_they_were(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_ROWS", 2)     # the empty payload is a frequent one
    made = [("a b%20", "u%0A", "x"), ("", "u\n%0A é", "x"), ("é>:\r\n", "", ""), (None, " u ", ""), ("7", None, None), ("07", "u", "")]
    df = spark.createDataFrame(made, "page_id string, url string, html string")
    index, folder = warc.write_archives(df)
    got = warc.read_records(index, folder).collect()
    assert sorted(((r.page_id, r.url) for r in got), key=repr) == sorted(((i, u) for i, u, _ in made), key=repr)
    assert {r.page_id: r.refers_to for r in got} == {"a b%20": None, "": "a b%20", "é>:\r\n": None, None: "é>:\r\n",
                                                     "7": "é>:\r\n", "07": "é>:\r\n"}
    dates = spark.createDataFrame([("2024-01-02", "u", "x")], "page_id string, url string, html string").selectExpr(
        "CAST(page_id AS date) AS page_id", "url", "html")
    assert str(warc.read_records(*warc.write_archives(dates)).first().page_id) == "2024-01-02"


# ---- 8 exact dedup

@pytest.mark.parametrize("keep,hot_rows", [("largest", 1000), ("smallest", 1000), ("largest", 2), ("smallest", 1)])
def test_exact_equals_brute_force(odd, empty, keep, hot_rows):
    got = exact.exact_dedup(odd, keep=keep, hot_rows=hot_rows).collect()
    groups = {}
    for i, t in ODD:
        groups.setdefault(t or "", []).append(i)
    best = max if keep == "largest" else min
    expected = [(i, best([x for x in groups[t or ""] if x is not None], default=None), len(groups[t or ""]),
                 hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD]
    assert multiset((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == multiset(expected)
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact.exact_dedup(empty).count() == 0


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_splits_long_copies_that_are_few(spark, odd, keep, monkeypatch):
    groups = []

    def noted(df, name):
        if name == "exact-rows":
            groups.append(df.agg({"_gn": "max"}).first()[0])
        return materialize(df, name)

    monkeypatch.setattr(exact, "materialize", noted)
    size, copies = 200_000, 300         # 60 MB of one text, fewer rows than HOT_ROWS
    df = spark.range(copies + 5).selectExpr("id AS doc_id", f"IF(id < {copies}, repeat('x', {size}), CAST(id AS string)) AS text")
    got = exact.exact_dedup(df, keep=keep).collect()
    assert groups and groups[0] * size <= exact.HOT_BYTES
    stays = copies - 1 if keep == "largest" else 0
    assert multiset((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == multiset(
        [(i, stays, copies, i == stays) for i in range(copies)] + [(i, i, 1, True) for i in range(copies, copies + 5)])
    whole = exact.exact_dedup(odd, keep=keep).collect()
    assert multiset(exact.exact_dedup(odd, keep=keep, hot_bytes=2).collect()) == multiset(whole)
    assert len(groups) == 2             # the split ran for the odd rows too


# ---- 9 packing

@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing_holds_every_id_once(request, rows, which):
    max_len = 2048 if which == "docs" else 64
    got = packing.pack_documents(request.getfixturevalue(which), tokenizer_path(), max_len=max_len, with_ids=True).collect()
    docs_ids = [(i, ids + b"\x01\0\0\0") for i, ids, _ in brute_bpe(rows if which == "docs" else ODD)]
    expected = [(i, s // 4, b[s:s + 4 * max_len], len(b) // 4) for i, b in docs_ids for s in range(0, len(b), 4 * max_len)]
    assert multiset((r.doc_id, r.start, bytes(r.ids), r.doc_tokens) for r in got) == multiset(expected)
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length == len(r.ids) // 4 for r in got)
    packs = {}
    for r in got:
        packs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in packs.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= max_len
    assert sorted(packs) == list(range(len(packs)))
    assert packing.pack_documents(request.getfixturevalue("empty"), tokenizer_path()).count() == 0


def test_frequent_length_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BUCKET_ROWS", 3)
    parts = spark.createDataFrame([(i, 0, 5 if i % 4 else 3, 0, 5) for i in range(100)],
                                  "id long, start long, length long, ids_crc32 long, doc_tokens long")
    got = packing.pack(parts, 10).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 100 and max(r.offset + r.length for r in got) <= 10


def test_shortest_pack_first_uses_each_rank_once():
    rng = random.Random(2)
    histogram = {n: rng.randrange(1, 40) for n in rng.sample(range(1, 129), 60)}
    placed = packing.shortest_pack_first(histogram, 128)
    for n, count in histogram.items():
        spans = sorted((lo, hi) for length, lo, hi, _, _ in placed if length == n)
        assert spans[0][0] == 0 and spans[-1][1] == count and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


# ---- 10 quality rules

def brute_stats(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    count = {}
    for x in windows:
        count[x] = count.get(x, 0) + 1
    covered = {k + d for k, x in enumerate(windows) if count[x] > 1 for d in range(8)}
    full = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(covered))


def test_stats_equal_brute_force(docs, rows, odd, empty):
    for df, source in ((docs, rows), (odd, ODD)):
        got = quality.text_stats(df).select("doc_id", *quality.BASE).collect()
        assert multiset(map(tuple, got)) == multiset((i, *brute_stats(t)) for i, t in source)
    assert quality.text_stats(empty).count() == 0


def test_rules_separate_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rules = quality.fit_rules(docs, labels.where("doc_id % 2 = 0"))
    assert rules.rules
    held = (quality.apply_rules(docs, rules).join(labels.where("doc_id % 2 = 1"), "doc_id")
            .where("NOT base_failed").select("quality", "kept").collect())
    right = sum((r.quality == 1) == r.kept for r in held)
    assert right / len(held) > 0.95


def test_rules_without_labels_keep_everything(odd, empty, spark):
    none = spark.createDataFrame([(None, 0), (3, None)], "doc_id long, quality int")
    assert quality.fit_rules(odd, none).rules == []
    got = quality.apply_rules(odd, quality.DecisionList())
    assert all(r.kept != r.base_failed for r in got.collect()) and got.count() == len(ODD)
    assert quality.apply_rules(empty, quality.DecisionList()).count() == 0


# ---- columns with the names of helpers, groups that must not lose their last row

CLASHING = "_t _w _gone _gid _grid _pii n_words kept row _ _n n_lines n_removed h1 fp _m `a.b` __pii".split()


def clashing(spark, texts):
    names = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *[f"{c}{i}" for c in CLASHING]) for i, t in enumerate(texts)],
                                 f"doc_id long, text string, {names}")


def own(rows, skip=()):
    return {r["doc_id"]: tuple(r[c.strip("`")] for c in CLASHING if c not in skip) for r in rows}


def test_helpers_clash_with_no_column(spark):
    texts = ["one two three\nmail a.b@c.de", "one two three", None, " ".join(f"w{i}" for i in range(60))]
    df = clashing(spark, texts)
    whole = own(df.collect())
    assert own(pii.redact(df).collect()) == whole and pii.redact(df).columns == df.columns
    assert own(pii.find_pii(df).collect()) == whole
    assert own(lines.dedup_lines(df, counts=False).collect()) == whole
    replaced = ("n_lines", "n_removed")
    assert own(lines.dedup_lines(df).collect(), replaced) == own(df.collect(), replaced)
    kept = simhash.keep_one(df).collect()
    assert own(kept) == {i: v for i, v in whole.items() if i in {r.doc_id for r in kept}}
    stats = quality.text_stats(df)
    assert own(stats.collect(), ("n_words",)) == own(df.collect(), ("n_words",))
    good = quality.keep_good(df, quality.DecisionList())
    assert good.columns == df.columns and own(good.collect()) == {3: whole[3]}


def test_keep_one_keeps_one_of_every_group(spark):
    a, b = "alpha beta gamma delta epsilon", "one two three four five six seven"
    for rows, expected in [([(1, a), (5, a), (5, b)], [(1, a), (5, b)]), ([(None, a), (None, a), (7, b)], [(7, b), (None, a)]),
                           ([(3, a), (3, a), (3, a)], [(3, a)]), ([(None, None), (None, ""), (None, b)], [(None, b), (None, None)]),
                           ([(2, b), (1, a), (2, a), (1, b)], [(1, a), (1, b)]), ([], [])]:
        df = spark.createDataFrame([(i, t, {"k": "v"}) for i, t in rows], "doc_id long, text string, extra map<string,string>")
        got = sorted(((r.doc_id, r.text or None) for r in simhash.keep_one(df).collect()), key=repr)
        assert got == sorted(expected, key=repr), rows


def test_redact_of_many_spans(spark):
    text = "".join(f"é😀 x{i}@mail.example, " for i in range(1500)) + "end"
    df = spark.createDataFrame([(1, text), (2, "a@b.c"), (3, "x")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: "é😀 [EMAIL], " * 1500 + "end", 2: "[EMAIL]", 3: "x"}


def test_html_hostile_nesting_is_linear():
    import time

    start = time.process_time()
    assert html.page_text("<p>" + "<div><p>" * 20_000 + "x").split() == ["x"]
    assert html.page_text("<table><td><p>" + "<div>" * 20_000 + "x").split() == ["x"]
    wide = "<table>" + "<tr>" + "".join(f"<td colspan=1000 rowspan=65534>{i}<tr>" for i in range(400)) + "</table>"
    assert html.page_text(wide).split() == [str(i) for i in range(400)]
    assert time.process_time() - start < 4


def test_html_long_cells_and_pre():
    long = "lorem ipsum dolor sit amet " * 4
    page = f"<table><tr><td>a<td>{long}<td>z1<tr><td>bb<td>short<td>z2</table><pre>\nx\n\ny</pre><textarea>\r\nt</textarea>"
    first, second, third = ("lorem ipsum dolor sit amet lorem ipsum dolor sit", "amet lorem ipsum dolor sit amet lorem ipsum",
                            "dolor sit amet")
    assert html.page_text(page) == (f"a   {first}  z1\n    {second}\n    {third}\n"
                                    f"bb  {'short'.ljust(48)}  z2\n\nx\n\ny\n\nt")
