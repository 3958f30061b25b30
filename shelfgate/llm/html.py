"""Layout-aware text of HTML pages.

A scanner feeds a tree builder that supplies implied end tags (paragraphs,
list items, table parts, options) and missing table rows; a renderer walks
the tree without recursion and emits all visible text with block spacing,
list markers and aligned table cells.

Elements of svg and math are named ``svg/g`` or ``math/mi`` in the tree (no tag
name holds a slash), so no rule for HTML elements applies to them.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import string_column

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript".split())
HIDDEN = frozenset("head title script style template noscript iframe object canvas audio video datalist "
                   "noembed noframes svg/defs svg/desc svg/metadata svg/title svg/style svg/script svg/symbol "
                   "svg/clippath svg/mask svg/marker svg/pattern math/annotation math/annotation-xml math/mphantom "
                   "math/style math/script".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset xmp".split())
BLOCK = PARAGRAPH | frozenset("html body address article aside center dd details dialog dir div dt figcaption footer "
                              "form header hgroup legend li main menu nav optgroup option search section select "
                              "summary tr caption".split())
CELL = frozenset(("td", "th"))
SECTION = frozenset(("thead", "tbody", "tfoot"))
CLOSES_P = PARAGRAPH | frozenset("address article aside center details dialog dir div dd dt figcaption footer form "
                                 "header hgroup li main menu nav search section summary".split())
# opening a tag closes these, up to the nearest of the second set
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir", "table"}), "dt": ({"dt", "dd"}, {"dl", "table"}),
           "dd": ({"dt", "dd"}, {"dl", "table"}), "option": ({"option"}, {"select", "datalist", "optgroup"}),
           "optgroup": ({"option", "optgroup"}, {"select"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}),
           "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
           "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
           "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
           "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
           "caption": ({"caption"}, {"table"}), "body": ({"head"}, {"html"})}
# inside svg and math: tags that end it, elements whose content is HTML again
BREAK_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
                      "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul "
                      "var".split())
MATH_TEXT = frozenset(("math/mi", "math/mo", "math/mn", "math/ms", "math/mtext"))
SVG_HTML = frozenset(("svg/foreignobject", "svg/desc", "svg/title"))
SCOPE = MATH_TEXT | SVG_HTML | {"math/annotation-xml"}
# the only elements of svg whose own text is shown; parts of svg and math that stand apart from what is beside them
SVG_TEXT = frozenset(("svg/text", "svg/tspan", "svg/textpath", "svg/foreignobject"))
APART = frozenset(("svg/text", "svg/foreignobject", "math/mtr", "math/mtd"))
FRACTION = frozenset(("math/mfrac", "math/mroot"))
# paragraphs around these are not closed from inside
SHIELDS = CELL | {"table", "caption"} | SCOPE
HEAD_ONLY = frozenset("base link meta title style script noscript template".split())
ALIGN = 48
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)?(\s*=\s*)?")
_HIDE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)
_SVG_VISIBILITY = re.compile(r"\s*(hidden|collapse|visible)\s*$")
_SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Node | None"):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []


def _attributes(page: str, at: int) -> tuple[dict[str, str], int, bool]:
    """Attributes from ``at``, the position behind the tag, and whether it closes itself. -1: never ends."""
    attrs: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(page, at)
        name, at, before = m[1], m.end(), page[m.end() - 1:m.end()]
        if name and m[2]:
            quote = page[at:at + 1]
            if quote in ("'", '"') and quote:
                end = page.find(quote, at + 1)
                if end < 0:
                    return attrs, -1, False
                value, at = page[at + 1:end], end + 1
            else:
                end = at
                while end < len(page) and page[end] not in " \t\n\f\r>":
                    end += 1
                value, at = page[at:end], end
            attrs.setdefault(name.lower(), unescape(value))
        elif name:
            attrs.setdefault(name.lower(), "")
        if at >= len(page):
            return attrs, -1, False
        if page[at] == ">":
            return attrs, at + 1, before == "/" and not name
        if page[at] == "=" or not name:
            at += 1


def scan(page: str, b: "Builder"):
    """Tokens: ("text", text), ("open", tag, (attributes, closes itself)), ("close", tag).
    What follows an open tag depends on where ``b`` put it."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", unescape(page[at:]), None
            return
        if lt > at:
            yield "text", unescape(page[at:lt]), None
        nxt = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2)
            at = n if end < 0 else end + 3
        elif page.startswith("<![CDATA[", lt) and "/" in b.node.tag:
            end = page.find("]]>", lt)
            yield "text", page[lt + 9:n if end < 0 else end], None
            at = n if end < 0 else end + 3
        elif nxt in ("!", "?") and nxt:
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
        elif nxt == "/" and _NAME.match(page, lt + 2):
            tag = _NAME.match(page, lt + 2)[0].lower()
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            yield "close", tag, None
        elif nxt == "/":
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
        elif m := _NAME.match(page, lt + 1):
            tag = m[0].lower()
            attrs, at, closed = _attributes(page, m.end())
            if at < 0:
                return  # a tag that never ends is no text
            yield "open", tag, (attrs, closed)
            if tag in RAW and b.node.tag == tag:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                end = close.start() if close else n
                raw = page[at:end]
                if raw:
                    yield "text", unescape(raw) if tag in ("textarea", "title") else raw, None
                at = end
        else:
            yield "text", "<", None
            at = lt + 1


def _takes_html(node: Node, tag: str) -> bool:
    """Whether a start tag in ``node`` follows the rules of HTML."""
    if node.tag in MATH_TEXT:
        return tag not in ("mglyph", "malignmark")
    if node.tag == "math/annotation-xml":
        return tag == "svg" or node.attrs.get("encoding", "").lower() in ("text/html", "application/xhtml+xml")
    return "/" not in node.tag or node.tag in SVG_HTML


class Builder:
    """The tree of one page. ``open`` counts open tags by name, so a missing one costs nothing;
    ``paragraphs`` counts open paragraphs inside each element that shields those around it."""

    def __init__(self):
        self.root = Node("#root", {}, None)
        self.node = self.root
        self.open: dict[str, int] = {}
        self.paragraphs = [0]

    def push(self, tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs, self.node)
        self.node.children.append(node)
        if tag not in VOID:
            self.node = node
            self.open[tag] = self.open.get(tag, 0) + 1
            if tag in SHIELDS:
                self.paragraphs.append(0)
            elif tag == "p":
                self.paragraphs[-1] += 1

    def pop(self) -> None:
        self.open[self.node.tag] -= 1
        if self.node.tag in SHIELDS:
            self.paragraphs.pop()
        elif self.node.tag == "p":
            self.paragraphs[-1] -= 1
        self.node = self.node.parent

    def close_until(self, tags, stop) -> None:
        """Close the outermost open tag of ``tags`` that is not beyond one of ``stop``."""
        if not any(self.open.get(t) for t in tags):
            return
        node, found = self.node, None
        while node.parent is not None and node.tag not in stop and node.tag not in SCOPE:
            if node.tag in tags:
                found = node
            node = node.parent
        if found is not None:
            while self.node is not found:
                self.pop()
            self.pop()

    def break_out(self) -> None:
        """Close svg and math up to an element whose content is HTML."""
        while not _takes_html(self.node, ""):
            self.pop()

    def start(self, tag: str, attrs: dict[str, str], closed: bool = False) -> None:
        if not _takes_html(self.node, tag):
            if tag not in BREAK_OUT and not (tag == "font" and attrs.keys() & {"color", "face", "size"}):
                self.push(f"{self.node.tag.split('/')[0]}/{tag}", attrs)
                if closed:
                    self.pop()
                return
            self.break_out()
        if tag in ("html", "body") and self.open.get(tag):
            return
        if self.open.get("head") and tag not in HEAD_ONLY and tag not in ("html", "head"):
            self.close_until({"head"}, ())
        if tag in CLOSES_P and self.paragraphs[-1]:  # the only one open here: what is walked is closed
            while self.node.tag != "p":
                self.pop()
            self.pop()
        if tag in IMPLIED:
            self.close_until(*IMPLIED[tag])
        if tag in CELL and self.open.get("table") and self.node.tag in ("table", *SECTION):
            self.push("tr", {})
        foreign = tag in ("svg", "math")
        self.push(f"{tag}/{tag}" if foreign else tag, attrs)
        if foreign and closed:
            self.pop()

    def end(self, tag: str) -> None:
        if "/" in self.node.tag:
            if tag in ("br", "p"):
                self.break_out()
            elif self.open.get(f"svg/{tag}") or self.open.get(f"math/{tag}"):
                node = self.node
                while "/" in node.tag and not node.tag.endswith(f"/{tag}"):
                    node = node.parent
                if "/" in node.tag:
                    while self.node is not node:
                        self.pop()
                    self.pop()
                    return
        if tag == "br":
            self.push("br", {})
        elif tag == "p" and not self.open.get("p"):
            self.push("p", {})
            self.pop()
        elif self.open.get(tag):
            stop = () if tag in ("table", "html", "body") else {"table"} if tag in CELL | SECTION | {"tr"} else CELL | SCOPE
            node = self.node
            while node.parent is not None and node.tag != tag and node.tag not in stop:
                node = node.parent
            if node.tag == tag:
                while self.node is not node:
                    self.pop()
                self.pop()

    def text(self, text: str) -> None:
        if self.open.get("head") and self.node.tag == "head" and text.strip():
            self.close_until({"head"}, ())
        if self.node.tag in ("table", "tr", *SECTION) and text.strip():
            table = self.node
            while table.tag != "table" and table.parent is not None:
                table = table.parent
            if table.tag == "table":  # text between cells stands before the table
                at = table.parent.children
                at.insert(len(at) - 1 if at and at[-1] is table else at.index(table), text)
                return
        self.node.children.append(text)


def build(page: str) -> Node:
    b = Builder()
    for kind, value, more in scan(page, b):
        if kind == "text":
            b.text(value)
        elif kind == "open":
            b.start(value, *more)
        else:
            b.end(value)
    return b.root


def _apart(node: Node) -> bool:
    """Whether a blank stands around a part of svg or math: a label, a placed piece of one, a cell, half a fraction."""
    return (node.tag in APART or node.tag == "svg/tspan" and bool(node.attrs.keys() & {"x", "y", "dy"})
            or node.tag.startswith("math/") and node.parent.tag in FRACTION)


class Flow:
    """Text under construction: lines, pending line breaks, collapsed white space."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.breaks = 0
        self.space = False
        self.indent = 0
        self.marker = ""

    def _flush(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip(" "))
            self.parts = []

    def gap(self, n: int) -> None:
        """At least ``n`` line breaks before what follows."""
        self.space = False
        self.breaks = max(self.breaks, n)

    def line_break(self) -> None:
        self.space = False
        if self.breaks:
            self.breaks += 1
        else:
            self._flush() if self.parts else self.lines.append("") if self.lines else None

    def raw(self, s: str) -> None:
        """Characters as they are, on the current line."""
        if self.breaks:
            self._flush()
            if self.lines:
                self.lines.extend([""] * (self.breaks - 1))
            self.breaks = 0
        if not self.parts:
            pad = " " * max(self.indent - len(self.marker), 0)
            self.parts.append(pad + self.marker)
            self.marker = ""
        elif self.space:
            self.parts.append(" ")
        self.space = False
        self.parts.append(s)

    def text(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if s.startswith(" "):
            self.space = bool(self.parts) and not self.breaks
            s = s[1:]
        if not s:
            return
        tail = s.endswith(" ")
        self.raw(s[:-1] if tail else s)
        self.space = tail

    def pre(self, s: str) -> None:
        for k, line in enumerate(s.replace("\r\n", "\n").split("\n")):
            if k:
                if self.breaks:
                    self.raw("")
                self._flush() if self.parts else self.lines.append("")
            if line:
                self.raw(line)

    def done(self) -> list[str]:
        self._flush()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _number(text: str | None, default: int, low: int, high: int) -> int:
    try:
        return min(max(int(text), low), high)
    except (TypeError, ValueError):
        return default


def _wrapped(lines: list[str]) -> list[str]:
    """Lines broken at blanks so that they have at most ``ALIGN`` characters, longer words aside."""
    out = []
    for line in lines:
        text = ""
        for word in line.split(" ") if len(line) > ALIGN else ():
            if text and len(text) + 1 + len(word) > ALIGN:
                out.append(text)
                text = word
            else:
                text = f"{text} {word}" if text else word
        out.append(text if len(line) > ALIGN else line)
    return out


def align(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table; a cell is (lines, columns, rows). Columns are as wide as their widest cell of
    one column, at most ``ALIGN``: longer lines of a cell are wrapped unless it is the last of its row."""
    width: dict[int, int] = {}
    placed = []
    taken: list[tuple[int, int, int]] = []  # (first column, last + 1, row it ends at) of cells from rows above
    for r, row in enumerate(rows):
        taken = [x for x in taken if x[2] > r]
        at, k, line, new = 0, 0, [], []
        for i, (lines, cols, height) in enumerate(row):
            while k < len(taken) and taken[k][0] <= at:
                at = max(at, taken[k][1])
                k += 1
            lines = _wrapped(lines) if i < len(row) - 1 else lines
            line.append((at, lines))
            if cols == 1:
                width[at] = max([width.get(at, 0), *(min(len(x), ALIGN) for x in lines)])
            if height > 1:
                new.append((at, at + cols, min(r + height, len(rows))))
            at += cols
        placed.append(line)
        if new:
            merged: list[tuple[int, int, int]] = []
            for a, b, end in sorted(taken + new):
                if merged and a < merged[-1][1]:
                    a = merged[-1][1]
                if merged and a == merged[-1][1] and end == merged[-1][2]:
                    merged[-1] = (merged[-1][0], max(b, a), end)
                elif a < b:
                    merged.append((a, b, end))
            taken = merged
    used = sorted({at for line in placed for at, _ in line})
    out = []
    start, pos = {}, 0
    for c in used:  # columns that no cell starts in take no room
        start[c] = pos
        pos += width.get(c, 0) + 2 if width.get(c) else 0
    for line in placed:
        for k in range(max((len(x) for _, x in line), default=0)):
            text = ""
            for at, lines in line:
                if k < len(lines) and lines[k]:
                    text = (text + "  " if text else "") if len(text) >= start[at] else text.ljust(start[at])
                    text += lines[k]
            out.append(text.rstrip())
    return out


def render(root: Node) -> str:
    """Visible text of a tree. The walk keeps its own stack, so depth is no limit."""
    flow = Flow()
    flows: list[Flow] = []
    tables: list[list] = []
    # a step is (node or text, False) to enter, (node, True) to leave; shown is inherited
    steps: list[tuple] = [(root, False, True, False)]
    lists: list[list] = []
    while steps:
        item, leaving, shown, pre = steps.pop()
        if isinstance(item, str):
            if shown:
                flow.pre(item) if pre else flow.text(item)
            continue
        tag = item.tag
        if leaving:
            if "/" in tag:
                flow.text(" ")
            elif tag in CELL and flows:
                lines = flow.done()
                flow = flows.pop()
                if tables:
                    rows = tables[-1]
                    if not rows:
                        rows.append([])
                    rows[-1].append((lines, _number(item.attrs.get("colspan"), 1, 1, 1000),
                                     _number(item.attrs.get("rowspan"), 1, 1, 65534)))
            elif tag == "table":
                lines = align(tables.pop())
                for k, line in enumerate(lines):
                    flow.gap(1) if k else None
                    flow.raw(line) if line else None
                flow.gap(2)
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                flow.indent -= 2 if lists else 0
                flow.gap(1 if lists else 2)
            elif tag == "li":
                flow.indent -= 2
                flow.marker = ""
                flow.gap(1)
            elif tag in ("blockquote", "dd"):
                flow.indent -= 2
                flow.gap(2 if tag == "blockquote" else 1)
            elif tag in BLOCK and tag != "tr":
                flow.gap(2 if tag in PARAGRAPH else 1)
            continue
        style = item.attrs.get("style", "")
        if (tag in HIDDEN or "hidden" in item.attrs or _HIDE.search(style)
                or tag == "dialog" and "open" not in item.attrs):
            continue
        if m := _VISIBILITY.search(style):
            shown = m[1].lower() == "visible"
        children = item.children
        if "/" in tag:
            if item.attrs.get("display", "").strip() == "none":
                continue
            if not m and (m := _SVG_VISIBILITY.match(item.attrs.get("visibility", ""))):
                shown = m[1] == "visible"
            if tag.startswith("svg/") and tag not in SVG_TEXT and not (tag == "svg/a" and item.parent.tag in SVG_TEXT):
                children = [c for c in children if isinstance(c, Node)]
            if _apart(item):
                flow.text(" ")
                steps.append((item, True, shown, pre))
            steps.extend((c, False, shown, pre) for c in reversed(children))
            continue
        if tag == "details" and "open" not in item.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        if tag == "br":
            if shown:
                flow.line_break()
            continue
        if tag in VOID:
            if tag == "hr":
                flow.gap(2)
            continue
        if tag in CELL and tables:
            flows.append(flow)
            flow = Flow()
        elif tag == "table":
            flow.gap(2)
            tables.append([])
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in ("ul", "ol", "menu", "dir"):
            flow.gap(1 if lists else 2)
            flow.indent += 2 if lists else 0
            lists.append([tag, _number(item.attrs.get("start"), 1, -10**9, 10**9)])
        elif tag == "li":
            flow.gap(1)
            kind = lists[-1] if lists else ["ul", 1]
            if kind[0] == "ol":
                kind[1] = _number(item.attrs.get("value"), kind[1], -10**9, 10**9)
                mark = f"{kind[1]}. "
                kind[1] += 1
            else:
                mark = "- "
            flow.indent += 2
            flow.marker = mark if shown else ""
        elif tag in ("blockquote", "dd"):
            flow.gap(2 if tag == "blockquote" else 1)
            flow.indent += 2
        elif tag in BLOCK:
            flow.gap(2 if tag in PARAGRAPH else 1)
        elif tag in CELL:
            flow.gap(1)
        pre = pre or tag in ("pre", "xmp", "textarea")
        if tag in ("pre", "textarea") and children and isinstance(children[0], str):  # a first line feed is not shown
            children = [re.sub(r"^\r?\n", "", children[0]), *children[1:]]
        steps.append((item, True, shown, pre))
        steps.extend((c, False, shown, pre) for c in reversed(children))
    return "\n".join(flow.done())


def page_text(page: str) -> str:
    return render(build(page))


def _extract(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            text = [page_text(p) for p in string_column(part, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(text, pa.string())], names=["id", "text"])


def extract_text(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Id and ``text`` of each row.

    Null and empty pages give the empty string; null ids and repeated rows
    keep their row; other columns are ignored; an empty table gives an empty
    result. Unclosed and stray tags, very deep nesting and very long pages
    are rendered whole. svg and math end as in the HTML standard: ``/>`` closes
    their elements, block tags close them. Of svg the labels are shown, of math
    all but annotations; labels, matrix cells and the halves of fractions are
    set apart by a blank.
    """
    src = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").alias("html"))
    id_type = pages.schema[id_col].dataType.simpleString()
    return src.mapInArrow(_extract, f"id {id_type}, text string").withColumnRenamed("id", id_col)
