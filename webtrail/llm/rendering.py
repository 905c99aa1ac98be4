"""HTML extraction by layout-aware rendering.

A scanner splits the page into tags and text, a builder makes a tree of elements with the tags
that HTML implies, and a renderer lays out what a reader would see.

* Implied tags: void elements take no content; a block ends an open paragraph; list items,
  terms, options, rows, cells and table sections end their predecessors; a cell makes its row.
  Text and any tag that may not stand in ``head`` end an open head.
  An end tag closes everything up to its element and is ignored if there is none.
* Visibility: no scripts, styles, templates, comments, head or embedded content, nor form fields
  (``textarea``, ``select``); nothing below ``hidden``, ``aria-hidden=true``, ``display:none`` or
  ``visibility:hidden``. Formulas and the texts of drawings are seen, but not what describes or
  defines them; HTML tags end a drawing or formula that is left open.
* Layout: paragraphs, headings, lists, tables and quotes stand apart by a blank line, other
  blocks by a line break. Items are marked ``-`` or numbered (from ``start``) and indented by
  level. ``pre`` keeps its blanks. A table whose cells have one line of at most ``CELL_WIDTH``
  characters is aligned in columns; the cells of any other table are blocks one after another.
  What stands in a table outside of its cells and captions comes before it.

Every step is one pass over the page without recursion, so depth and unclosed tags cost no more
than their length. A null or empty page gives an empty text. Repeated rows, null ids and other
columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head title script style template noscript noembed noframes iframe object embed applet audio video canvas "
    "datalist textarea select area base link meta param source track map".split()
)
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr menu dir".split())
BLOCKS = APART | frozenset(
    "html body div section article aside nav header footer main address form fieldset li dt dd details summary "
    "figcaption center caption legend optgroup option hgroup search dialog tr td th thead tbody tfoot".split()
)
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
CELLS = frozenset(("td", "th"))
LISTS = frozenset(("ul", "ol", "menu", "dir"))
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
FOREIGN = ("svg", "math")
#: Inside of drawings and formulas: HTML may stand in these,
HOLDS_HTML = ("foreignobject", "desc", "title", "annotation-xml", "mi", "mo", "mn", "ms", "mtext")
#: these HTML tags end one that is open,
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: these are not seen,
FOREIGN_UNSEEN = frozenset(
    "annotation annotation-xml mphantom desc metadata defs symbol clippath mask marker pattern lineargradient "
    "radialgradient filter".split()
)
#: and text directly in these is not drawn.
SHAPES = frozenset("svg g path rect circle ellipse line polyline polygon use image switch view".split())
CELL_WIDTH = 80
GAP = "  "
SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
BLANK = " \t\n\r\f"
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"[^\s/>=][^\s/>=]*")
BARE = re.compile(r"[^\s>]*")
SKIP = re.compile(r"[\s/]*")
SPACES = re.compile(r"[ \t\n\r\f]+")
HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Element:
    __slots__ = ("tag", "attrs", "children", "foreign")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children, self.foreign = tag, attrs or {}, [], False

    def visible(self) -> bool:
        if self.tag in UNSEEN or self.foreign and self.tag in FOREIGN_UNSEEN:
            return False
        a = self.attrs
        if not a:
            return True
        if "hidden" in a or a.get("aria-hidden", "").lower() == "true":
            return False
        if self.foreign and (a.get("display") == "none" or a.get("visibility") in ("hidden", "collapse")):
            return False
        return not ("style" in a and HIDING.search(a["style"]))


class Scanner:
    """(kind, value, attributes) of the page in order: ``text``, ``open``, ``close``."""

    def __init__(self, page: str):
        self.page = page
        self.last = {q: page.rfind(q) for q in "\"'"}
        self.lower: str | None = None
        #: Inside of a drawing or formula, as the reader of the tags has it.
        self.foreign = False
        self.slash = False

    def attributes(self, at: int) -> tuple[dict[str, str], int]:
        """Attributes from ``at`` on, and where the tag ends."""
        page, found = self.page, {}
        while True:
            before, at = at, SKIP.match(page, at).end()
            self.slash = at > before and page[at - 1] == "/"
            if at >= len(page):
                return found, at
            if page[at] == ">":
                return found, at + 1
            m = ATTRIBUTE.match(page, at)
            if not m:
                at += 1
                continue
            name, at = m.group().lower(), m.end()
            value = ""
            after = at
            while after < len(page) and page[after] in BLANK:
                after += 1
            if after < len(page) and page[after] == "=":
                at = after + 1
                while at < len(page) and page[at] in BLANK:
                    at += 1
                quote = page[at : at + 1]
                if quote and quote in "\"'" and self.last[quote] > at:
                    end = page.index(quote, at + 1)
                    value, at = page[at + 1 : end], end + 1
                else:
                    m = BARE.match(page, at)
                    value, at = m.group(), m.end()
            found.setdefault(name, unescape(value) if "&" in value else value)

    def __iter__(self):
        page, at, size = self.page, 0, len(self.page)
        while at < size:
            start = page.find("<", at)
            if start < 0:
                yield "text", page[at:], None
                return
            if start > at:
                yield "text", page[at:start], None
            mark = page[start + 1 : start + 2]
            if self.foreign and page.startswith("<![CDATA[", start):
                end = page.find("]]>", start)
                end = size if end < 0 else end
                yield "text", page[start + 9 : end].replace("&", "&amp;"), None
                at = end + 3
            elif mark == "!" or mark == "?":
                closing = "-->" if page.startswith("<!--", start) else ">"
                end = page.find(closing, start + 2)
                at = size if end < 0 else end + len(closing)
            elif mark == "/" and (m := NAME.match(page, start + 2)):
                end = page.find(">", m.end())
                at = size if end < 0 else end + 1
                yield "close", m.group().lower(), None
            elif m := NAME.match(page, start + 1):
                tag = m.group().lower()
                attrs, at = self.attributes(m.end())
                yield "open", tag, attrs
                if self.foreign and self.slash:
                    yield "close", tag, None
                elif tag in RAW:
                    end = self.closing(tag, at)
                    yield "text", page[at:end], None
                    yield "close", tag, None
                    at = end
            else:
                yield "text", "<", None
                at = start + 1

    def closing(self, tag: str, at: int) -> int:
        """Where the raw content of ``tag`` ends: at its end tag, or with the page."""
        if self.lower is None:
            self.lower = self.page.translate(SMALL)
        while True:
            at = self.lower.find("</" + tag, at)
            if at < 0:
                return len(self.page)
            after = self.lower[at + 2 + len(tag) : at + 3 + len(tag)]
            if not after or after in " \t\n\r\f/>":
                return at
            at += 2


class Builder:
    """The tree of a page. The depths of the open elements of a tag tell what is inside of what."""

    def __init__(self):
        self.root = Element("#root")
        self.stack = [self.root]
        self.depths: dict[str, list[int]] = {}

    def push(self, tag: str, attrs=None) -> None:
        made = Element(tag, attrs)
        made.foreign = tag in FOREIGN or self.foreign()
        self.stack[-1].children.append(made)
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.stack))
            self.stack.append(made)

    def innermost(self, tags) -> int:
        """The depth of the innermost open element of ``tags``, or 0."""
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)

    def close(self, tags, within=()) -> None:
        """Close the innermost open element of ``tags``, unless one of ``within`` is inside of it."""
        depth = self.innermost(tags)
        if depth > self.innermost(within):
            while len(self.stack) > depth:
                self.depths[self.stack.pop().tag].pop()

    def foreign(self) -> bool:
        """Inside of a drawing or formula, and not in HTML inside of it."""
        return self.stack[-1].foreign and self.stack[-1].tag not in HOLDS_HTML

    def end_head(self) -> None:
        """The head ends, with or without its end tag, before what may not stand in it."""
        while self.stack[-1].tag == "head":
            self.close(("head",))

    def open(self, tag: str, attrs) -> None:
        if tag not in IN_HEAD:
            self.end_head()
        if tag in ENDS_FOREIGN or tag == "font" and not {"color", "face", "size"}.isdisjoint(attrs):
            while self.foreign():
                self.close(FOREIGN)
        if tag in BLOCKS and tag not in ("html", "body"):
            self.close(("p",), ("td", "th", "caption", "table"))
        if tag == "li":
            self.close(("li",), LISTS)
        elif tag in ("dt", "dd"):
            self.close(("dt", "dd"), ("dl",))
        elif tag in ("option", "optgroup"):
            self.close(("option",) if tag == "option" else ("option", "optgroup"), ("select", "datalist"))
        elif self.innermost(("table",)):
            if tag in CELLS:
                self.close(CELLS, ("tr", "table"))
                if self.stack[-1].tag != "tr":
                    self.open("tr", {})
            elif tag == "tr":
                self.close(("tr",), ("table",))
            elif tag in SECTIONS:
                self.close(SECTIONS, ("table",))
        self.push(tag, attrs)

    def feed(self, page: str) -> Element:
        scanner = Scanner(page)
        for kind, value, attrs in scanner:
            if kind == "text":
                if self.stack[-1].tag == "head" and value.strip(BLANK):
                    self.end_head()
                self.stack[-1].children.append(value)
            elif kind == "open":
                self.open(value, attrs)
            elif value == "br":
                self.end_head()
                self.push("br")
            else:
                within = () if value in ("table", "body", "html") else ("table",) if value in CELLS | SECTIONS | {"tr"} else CELLS
                self.close((value,), within)
            scanner.foreign = self.stack[-1].foreign
        return self.root


class Lines:
    """Text laid out so far: finished lines, and the line that is being filled."""

    def __init__(self):
        self.done: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.apart = 0
        self.indent = 0
        self.mark = ""

    def words(self, text: str) -> None:
        text = unescape(text) if "&" in text else text
        body = SPACES.sub(" ", text)
        if body.startswith(" "):
            self.space, body = True, body[1:]
        if not body:
            return
        ends = body.endswith(" ")
        self._start()
        if self.space and self.line and not self.line[-1].endswith("\n"):
            self.line.append(" ")
        self.line.append(body[:-1] if ends else body)
        self.space = ends

    def exact(self, text: str) -> None:
        text = unescape(text) if "&" in text else text
        for k, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                self.feed()
            if part:
                self._start()
                self.line.append(part)

    def _start(self) -> None:
        if not self.line:
            if self.apart and self.done:
                self.done += [""] * (self.apart - 1)
            self.apart = 0
            mark, self.mark = self.mark, ""
            self.line.append(GAP * self.indent + mark if not mark else GAP * (self.indent - 1) + mark)
            self.space = False

    def feed(self) -> None:
        """A line break."""
        if self.line:
            self.done.append("".join(self.line).rstrip())
            self.line = []
        elif self.done:
            self.done.append("")
        self.space = False

    def rest(self, blank: bool) -> None:
        """The end of a block: what follows starts a line, after a blank one if ``blank``."""
        if self.line:
            self.done.append("".join(self.line).rstrip())
            self.line = []
        self.space = False
        self.apart = max(self.apart, 2 if blank else 1)

    def add(self, lines: list[str]) -> None:
        for text in lines:
            if text:
                self._start()
                self.line.append(text)
            self.feed()
        self.rest(True)

    def finished(self) -> list[str]:
        self.rest(False)
        lines = self.done
        while lines and not lines[-1].strip():
            lines.pop()
        return lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int]]] = []
        self.titles: list[list[str]] = []

    def aligned(self) -> list[str]:
        """Columns side by side if all cells are short, or the cells one after another."""
        cells = [c for row in self.rows for c, _ in row]
        if any(len(c) > 1 or (c and len(c[0]) > CELL_WIDTH) for c in cells):
            return [line for row in self.rows for c, _ in row for line in c]
        widths: dict[int, int] = {}
        for row in self.rows:
            at = 0
            for c, span in row:
                if span == 1:
                    widths[at] = max(widths.get(at, 0), len(c[0]) if c else 0)
                at += span
        made = []
        for row in self.rows:
            at, line = 0, ""
            for c, span in row:
                width = sum(widths.get(k, 0) for k in range(at, at + span)) + len(GAP) * (span - 1)
                line += (c[0] if c else "").ljust(width) + GAP
                at += span
            if line.strip():
                made.append(line.rstrip())
        return made


def span_of(attrs: dict[str, str]) -> int:
    value = attrs.get("colspan", "")
    return min(int(value), 1000) if value.isascii() and value.isdigit() and 0 < len(value) < 9 and int(value) else 1


def layout(root: Element) -> str:
    """The visible text of a tree."""
    lines = Lines()
    outer: list[Lines] = []
    tables: list[Table] = []
    lists: list[list] = []
    exact = 0
    work: list[tuple] = [(root, False)]
    while work:
        node, leaving = work.pop()
        if isinstance(node, str):
            lines.exact(node) if exact else lines.words(node)
            continue
        tag = node.tag
        if leaving:
            if tag in CELLS and tables:
                cell, lines = lines.finished(), outer.pop()
                if not tables[-1].rows:
                    tables[-1].rows.append([])
                tables[-1].rows[-1].append((cell, span_of(node.attrs)))
            elif tag == "caption" and tables:
                cell, lines = lines.finished(), outer.pop()
                tables[-1].titles.append(cell)
            elif tag == "table":
                stray, lines = lines.finished(), outer.pop()
                made = tables.pop()
                lines.rest(True)
                lines.add(stray)
                lines.add([x for t in made.titles for x in t] + made.aligned())
            else:
                if tag in LISTS:
                    lists.pop()
                    lines.indent -= 1
                elif tag in ("blockquote", "dd"):
                    lines.indent -= 1
                elif tag == "pre":
                    exact -= 1
                elif tag == "li":
                    lines.mark = ""
                lines.rest(tag in APART and not (tag in LISTS and lists))
            continue
        if not node.visible():
            continue
        if tag == "br":
            lines.feed()
            continue
        if tag == "hr":
            lines.rest(True)
            continue
        block = tag in BLOCKS
        if tag in CELLS and tables or tag == "caption" and tables:
            outer.append(lines)
            lines = Lines()
        elif tag == "table":
            lines.rest(True)
            outer.append(lines)
            lines = Lines()
            tables.append(Table())
        elif tag == "tr" and tables:
            tables[-1].rows.append([])
        elif block:
            lines.rest(tag in APART and not (tag in LISTS and lists))
            if tag in LISTS:
                start = node.attrs.get("start", "1")
                number = int(start) if start.isascii() and start.isdigit() and len(start) < 10 else 1
                lists.append([tag == "ol", number])
                lines.indent += 1
            elif tag in ("blockquote", "dd"):
                lines.indent += 1
            elif tag == "pre":
                exact += 1
            elif tag == "li":
                kind = lists[-1] if lists else [False, 1]
                lines.mark = f"{kind[1]}. " if kind[0] else "- "
                kind[1] += 1
                if not lists:
                    lines.mark = "" if lines.indent == 0 else lines.mark
        if block:
            work.append((node, True))
        if node.foreign and tag == "text":
            lines.space = True
            work.append((" ", False))
        drawn = not (node.foreign and tag in SHAPES)
        work += [(c, False) for c in reversed(node.children) if drawn or not isinstance(c, str)]
    return "\n".join(lines.finished())


def render(page: str | None) -> str:
    """All visible text of an HTML page, laid out."""
    return layout(Builder().feed(page)) if page else ""


@F.arrow_udf(StringType())
def text_of(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in pages:
        yield pa.array([render(p.as_py()) for p in batch], pa.string())


def rendered(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the layout of ``html``, which is dropped; other columns stay as they are."""
    html = pages["html"]
    return pages.drop("text").withColumn("text", text_of(html)).drop("html")


def op1_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return rendered(pages)
