"""Layout-aware text of HTML pages.

A tree is built with the tags that HTML implies (an open paragraph ends where a
block begins, a list item where the next begins, cells and rows likewise), and
what is visible is written from it: blocks on lines of their own with blank
lines where a browser has margins, list items with bullets or numbers and
indented by depth, the cells of tables aligned in columns, preformatted text as
it stands. Hidden is what ``display: none``, ``hidden`` or its element hides;
``visibility`` goes down the tree until an element sets it anew; of ``details``
that are not open the summary shows, of a ``dialog`` that is not open nothing.
Cells that span columns or rows keep their columns. A text's length follows its
page's: cells wider than ``WIDEST`` do not widen a column, a cell that stands
more than ``GAP`` blanks behind the one before has the number of its column in
place of blanks, and items deeper than ``DEEP`` have that of their depth.

Defined cases: a null or empty page gives an empty text; markup that does not
close, end tags without a start and unknown tags are read as browsers do in
spirit: nothing visible is lost; depth is not bounded by Python's stack, and
time follows a page's length, also where tags do not match; rows that repeat
keep their row each. Columns other than id and html are not read.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from bisect import bisect, bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .storage import table

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))                                  # comment, also one that ends where it begins or with a mark
      | <[!?][^>]*(?:>|\Z)                                           # declaration
      | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)
        (?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))       # tag, also with a quote that stays open
    """,
    re.S | re.X,
)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
# Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript title meta link iframe noembed noframes datalist audio video canvas".split())
HEAD = frozenset("base link meta script style template title noscript".split())
FOREIGN_HIDDEN = frozenset("defs desc metadata symbol annotation annotation-xml".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr".split())
BLOCK = SPACED | frozenset("html body address article aside center details dialog dd div dt fieldset figcaption footer form header hgroup legend li main menu nav section summary search tr caption option optgroup".split())
CLOSES_P = BLOCK - {"html", "body", "tr", "caption", "legend", "option", "optgroup"}
# Which open elements a start tag ends, and what stops the search for them.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
_NO_BOX = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
_CELLS, _PARTS = frozenset({"td", "th"}), frozenset("table tr td th thead tbody tfoot body html".split())
#: The widest cell that widens its column, the most blanks between cells, and the most levels of a list that are shown by blanks.
WIDEST, GAP, DEEP = 100, 200, 24


class Node:
    """An element: ``seen`` is its own visibility, None where it takes that of its parent; ``spans`` are columns and rows of a cell; ``start`` is a list's first number, an item's own number, if it has one, and 0 for details that are closed."""

    __slots__ = ("tag", "hidden", "start", "children", "seen", "spans")

    def __init__(self, tag: str, hidden: bool = False, start: int | None = 1, seen: bool | None = None, spans: tuple[int, int] = (1, 1)):
        self.tag, self.hidden, self.start, self.children, self.seen, self.spans = tag, hidden, start, [], seen, spans


class _Open:
    """The open elements, and where those of each name stand among them."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], defaultdict(list)
        self.walls: list[int] = []  # what keeps a block inside from ending a paragraph outside
        self.cells: list[int] = []  # cells and tables

    def push(self, node: Node) -> None:
        k = len(self.nodes)
        self.nodes.append(node)
        self.places[node.tag].append(k)
        if node.tag in _WALLS:
            self.walls.append(k)
        if node.tag in _CELLS or node.tag == "table":
            self.cells.append(k)

    def cut(self, k: int) -> None:
        """End the elements from place k on."""
        for node in self.nodes[k:]:
            self.places[node.tag].pop()
        del self.nodes[k:]
        for places in (self.walls, self.cells):
            while places and places[-1] >= k:
                places.pop()

    def last(self, tags) -> int:
        """The place of the innermost of these; 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


_WALLS = (BLOCK | _CELLS | {"button"}) - {"p"}


def _number(text: str, most: int) -> int:
    return min(int(text), most) if re.fullmatch(r"\d{1,9}", text.strip(), re.A) else 1


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        out.setdefault(m[1].lower(), entities.unescape((m[2] or "").strip("\"'")))
    return out


def parse(page: str) -> Node:
    """The tree of a page; text is held as strings among the children."""
    root = Node("#root")
    stack, at, size = _Open(root), 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            _text(stack, page[at:])
            break
        if m.start() > at:
            _text(stack, page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            _close(stack, tag)
            continue
        attrs = m["attrs"].rstrip(">")
        _imply(stack, tag)
        known = _attributes(attrs) if attrs.strip(" /") else {}
        foreign = (tag in FOREIGN_HIDDEN or attrs.endswith("/")) and (tag in ("svg", "math") or stack.last(("svg", "math")) > 0)
        style = known.get("style", "")
        closed = tag in ("details", "dialog") and "open" not in known
        hidden = tag in HIDDEN or foreign and tag in FOREIGN_HIDDEN or "hidden" in known or bool(_NO_BOX.search(style)) or closed and tag == "dialog"
        shown = _VISIBILITY.findall(style)
        number = known.get({"ol": "start", "li": "value"}.get(tag, ""), "").strip()
        own = int(number) if re.fullmatch(r"[-+]?\d{1,9}", number, re.A) else None if tag == "li" else 1
        spans = (max(1, _number(known.get("colspan", "1"), 1000)), _number(known.get("rowspan", "1"), 65534)) if tag in _CELLS else (1, 1)
        node = Node(tag, hidden, (0 if closed else 1) if tag == "details" else own, shown[-1].lower() == "visible" if shown else None, spans)
        stack.nodes[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            if not node.hidden:
                raw = page[at : end.start() if end else size]
                node.children.append(entities.unescape(raw) if tag == "textarea" else raw)
            at = end.end() if end else size
        elif tag not in VOID and not (attrs.endswith("/") and (foreign or tag not in BLOCK and tag in HIDDEN)):
            stack.push(node)
    return root


def _text(stack: _Open, text: str) -> None:
    if stack.nodes[-1].tag == "head" and not text.isspace():
        stack.cut(len(stack.nodes) - 1)
    stack.nodes[-1].children.append(entities.unescape(text))


def _imply(stack: _Open, tag: str) -> None:
    if stack.nodes[-1].tag == "head" and tag not in HEAD:
        stack.cut(len(stack.nodes) - 1)
    if tag in CLOSES_P and (p := stack.last("p")) and not (stack.walls and stack.walls[-1] > p):
        stack.cut(p)
    ended, stop = IMPLIED_END.get(tag, (set(), set()))
    if ended:
        wall = stack.last(stop)
        places = [p[-1] if tag in ("li", "dt", "dd", "option") else p[k] for p in (stack.places.get(t, []) for t in ended) if (k := bisect(p, wall)) < len(p)]
        if places:
            stack.cut(max(places) if tag in ("li", "dt", "dd", "option") else min(places))
    if tag in _CELLS and stack.nodes[-1].tag in ("table", "thead", "tbody", "tfoot"):
        row = Node("tr")
        stack.nodes[-1].children.append(row)
        stack.push(row)


def _close(stack: _Open, tag: str) -> None:
    """End the nearest open element of that name; a cell or a table keeps tags inside from ending what is outside."""
    k = stack.last((tag,))
    if k and (tag in _PARTS or not stack.cells or stack.cells[-1] <= k):
        stack.cut(k)
    elif tag in ("br", "p"):  # as browsers do, an element of its own
        stack.nodes[-1].children.append(Node(tag))


class _Writer:
    """Text under way: collapses blanks and holds back line ends until more text comes."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks, self.blank, self.prefix = 0, False, ""

    def _start(self) -> None:
        if self.breaks:
            if self.parts:
                self.parts.append("\n" * self.breaks)
            self.parts.append(self.prefix)
            self.prefix = " " * len(self.prefix)
        elif not self.parts:
            self.parts.append(self.prefix)
            self.prefix = " " * len(self.prefix)
        elif self.blank:
            self.parts.append(" ")
        self.breaks, self.blank = 0, False

    def text(self, s: str) -> None:
        words = s.split()
        if not words:
            self.blank |= bool(s)
            return
        self.blank |= s[0].isspace()
        self._start()
        self.parts.append(" ".join(words))
        self.blank = s[-1].isspace()

    def verbatim(self, s: str) -> None:
        for i, line in enumerate(s.split("\n")):
            if i:
                self.breaks += 1
            if line:
                self._start()
                self.parts.append(line)

    def lines(self, lines: list[str]) -> None:
        for line in lines:
            self.block(1)
            self._start()
            self.parts.append(line)
        self.block(1)

    def block(self, breaks: int) -> None:
        self.breaks, self.blank = max(self.breaks, breaks), False

    def value(self) -> str:
        return "\n".join(x.rstrip() for x in "".join(self.parts).split("\n")).strip("\n")


def _width(s: str) -> int:
    return len(s) if s.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def _placed(rows: list[list[tuple[str, int, int]]]) -> list[dict[int, tuple[list[str], int]]]:
    """For each row its cells, as lines and columns spanned, by first column; rows that cells reach into leave their columns free."""
    out: list[dict[int, tuple[list[str], int]]] = []
    free: list[int] = []  # of the columns before ``limit`` those into which no cell from above reaches
    limit, busy, ends = 0, defaultdict(int), defaultdict(list)
    for r, row in enumerate(rows):
        for column in ends.pop(r, ()):
            busy[column] -= 1
            if not busy[column]:
                insort(free, column)
        at, placed = 0, {}
        for text, wide, high in row:
            k = bisect_left(free, at)
            at = free[k] if k < len(free) else max(at, limit)
            placed[at] = (text.split("\n"), wide)
            if high != 1:
                free.extend(range(limit, at + wide))
                limit = max(limit, at + wide)
                for column in range(at, at + wide):
                    busy[column] += 1
                    if busy[column] == 1:
                        del free[bisect_left(free, column)]
                    if high:
                        ends[r + high].append(column)
            at += wide
        out.append(placed)
    return out


def _aligned(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Rows of cells (text of maybe several lines, columns and rows spanned) in columns two blanks apart."""
    grid = _placed(rows)
    first = sorted({c for row in grid for c in row})  # columns where no cell begins need no room
    number = {c: k for k, c in enumerate(first)}
    table = []
    for row in grid:
        table.append({number[c]: (lines, bisect(first, c + wide - 1) - number[c]) for c, (lines, wide) in row.items()})
    widths = [0] * len(first)
    for row in table:
        for k, (lines, wide) in row.items():
            if wide == 1:
                widths[k] = max([widths[k], *(w for x in lines if (w := _width(x)) <= WIDEST)])
    edges = [0]
    for w in widths:
        edges.append(edges[-1] + w + 2)
    out = []
    for row in table:
        if not any(any(lines) for lines, _ in row.values()):
            continue
        for n in range(max(len(lines) for lines, _ in row.values())):
            parts, end = [], 0
            for k in sorted(row):
                lines, _ = row[k]
                if n < len(lines) and lines[n]:
                    # Where a cell before is wider than its columns, two blanks at least.
                    gap = max(edges[k] - end, 2 if parts else 0)
                    parts.append((" " * gap if gap <= GAP else f"  [{k + 1}] ") + lines[n])
                    end += gap + _width(lines[n])
            out.append("".join(parts))
    return out


def render(root: Node) -> str:
    """The visible text of a tree."""
    writers, tables, lists = [_Writer()], [], []
    pre = 0
    todo: list[tuple[Node | str, bool, bool]] = [(root, False, True)]
    while todo:
        node, done, seen = todo.pop()
        out = writers[-1]
        if isinstance(node, str):
            if seen:
                (out.verbatim if pre else out.text)(node)
            continue
        tag = node.tag
        if not done:
            if node.hidden:
                continue
            if tag == "br":
                out.breaks, out.blank = out.breaks + 1, False
                continue
            if tag in BLOCK:
                out.block(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
            if tag == "hr":
                out.lines(["---"])
                out.block(2)
            elif tag in ("ul", "ol", "menu"):
                lists.append([tag == "ol", node.start, out.prefix])
            elif tag == "li":
                if lists and node.start is not None:
                    lists[-1][1] = node.start
                numbered, number, _ = lists[-1] if lists else (False, 1, "")
                depth = len(lists) - 1
                out.prefix = "  " * min(depth, DEEP) + (f"({depth + 1}) " if depth > DEEP else "") + (f"{number}. " if numbered else "- ")
                if lists:
                    lists[-1][1] += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                writers.append(_Writer())
            pre += tag == "pre"
            seen = seen if node.seen is None else node.seen
            children = node.children
            if tag == "details" and not node.start:
                children = [x for x in children if not isinstance(x, str) and x.tag == "summary"][:1]
            todo.append((node, True, seen))
            todo.extend((child, False, seen) for child in reversed(children))
            continue
        pre -= tag == "pre"
        if tag in ("td", "th") and tables:
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((writers.pop().value(), *node.spans))
            continue
        if tag in ("ul", "ol", "menu"):
            out.prefix = lists.pop()[2]
        elif tag == "li":
            out.prefix = lists[-1][2] if lists else ""
        elif tag == "table":
            out.lines(_aligned(tables.pop()))
        if tag in BLOCK:
            out.block(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
    return writers[0].value()


def visible_text(page: str | None) -> str:
    return render(parse(page)) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text, n_chars) of every row. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInArrow(run, f"page_id {kind}, text string, n_chars long")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "html"))
