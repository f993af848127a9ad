"""Text of web pages as it would be laid out: blocks, lists and aligned tables.

A page is read once. Its tags build a tree as browsers do: void elements have no
content, scripts and the like are raw text, and missing tags are implied (a paragraph
ends before a block, a list item before the next, cells, rows and table parts before
their likes, a cell opens a row, the head ends where content begins). An end tag closes
the elements inside its own and does nothing if its element is not open; a table's
content is closed by the table only.

What is hidden is left out with all that is inside: head, scripts, styles, templates,
frames, media, drawings, fields of type hidden, ``hidden`` attributes, and inline styles
``display:none`` and ``visibility:hidden``. All other text is kept. White space collapses
as in browsers but in ``pre`` and ``textarea``. Blocks stand on lines of their own,
paragraphs, headings, lists and tables with an empty line around them. List items begin
with ``- `` or their number and are indented by depth. The cells of a table are aligned in
columns; a cell wider than ``WIDEST`` is written in full but does not widen its column.

Defined results: NULL is NULL; empty pages, and pages without visible text, give the
empty text; repeated rows are rendered each; unfinished tags and comments end with the page;
empty tables give empty tables. Other columns stay, and one named like the result is
replaced. Depth is not limited, and time grows with the length of the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import slices

WIDEST = 80
_SPANS = 1000  # columns or rows that a cell may span, the public standard's limit

# Kinds of elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = set(
    "head script style title template noscript iframe noembed noframes object svg math canvas"
    " audio video datalist link meta base".split()
)
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset menu".split())
BLOCKS = SPACED | set(
    "html body address article aside details dialog dd div dt footer form header hgroup hr legend"
    " li main nav section summary center dir search option optgroup figcaption caption tr".split()
)
ENDS_PARAGRAPH = (BLOCKS - {"html", "body", "option", "optgroup", "tr", "caption"}) | {"table"}
HEAD_PARTS = set("base basefont bgsound link meta noframes noscript script style template title".split())
TABLE_PARTS = set("caption colgroup col thead tbody tfoot tr td th".split())
# A start tag closes open elements of these names, up to the nearest of the bounds.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist", "optgroup", "table"}),
    "optgroup": ({"option", "optgroup"}, {"select", "table"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "caption": ({"caption", "tr", "td", "th"}, {"table"}),
}

_WHITE = " \t\n\f\r"
_COLLAPSE = re.compile(r"[ \t\n\f\r]+")
_TAG = re.compile(r"""(/?)([a-zA-Z][^ \t\n\f\r/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"(/?)([a-zA-Z][^ \t\n\f\r/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(
    r"""([^ \t\n\f\r/>=]+)(?:[ \t\n\f\r]*=[ \t\n\f\r]*(?:"([^"]*)"|'([^']*)'|([^ \t\n\f\r>]*)))?"""
)
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


class Flow:
    """Lines of a page or of a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.blank = False
        self.marks: list[list] = []  # of the open list items: text before the first line, indent

    def text(self, value: str) -> None:
        core = value.strip(_WHITE)
        if not core:
            self.space = self.space or bool(value)
            return
        if self.parts and (self.space or value[0] in _WHITE):
            self.parts.append(" ")
        self.parts.append(_COLLAPSE.sub(" ", core))
        self.space = value[-1] in _WHITE

    def kept_text(self, value: str) -> None:
        """Text whose white space counts."""
        first, *rest = value.replace("\r\n", "\n").split("\n")
        if first:
            self.parts.append(first)
        for line in rest:
            self.line(force=True)
            if line:
                self.parts.append(line)
        self.space = False

    def line(self, force: bool = False) -> None:
        """End the line."""
        if self.parts or force:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            before = ""
            if self.marks:
                before = self.marks[-1][0]
                self.marks[-1][0] = " " * self.marks[-1][1]
            self.lines.append((before + "".join(self.parts)).rstrip())
            self.parts = []
        self.space = False

    def block(self, spaced: bool) -> None:
        self.line()
        # An item's mark stays with its first line.
        if spaced and not (self.marks and self.marks[-1][0].strip()):
            self.blank = True

    def finished(self) -> list[str]:
        self.line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        while self.lines and not self.lines[0]:
            self.lines.pop(0)
        return self.lines


class Grid:
    """The cells of a table."""

    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.taken: dict[int, int] = {}  # columns that a cell of an earlier row still spans

    def row(self) -> None:
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.rows.append([])

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        own = self.rows[-1]
        at = own[-1][0] + own[-1][1] if own else 0
        while at in self.taken:
            at += 1
        own.append((at, columns, lines))
        if rows > 1:
            self.taken |= dict.fromkeys(range(at, at + columns), rows)

    def lines(self) -> Iterator[str]:
        widths: dict[int, int] = {}
        for row in self.rows:
            for at, columns, lines in row:
                width = max(map(len, lines), default=0)
                if columns == 1 and width <= WIDEST:
                    widths[at] = max(widths.get(at, 0), width)
        begins, at = {}, 0
        for column in range(max(widths, default=-1) + 1):
            begins[column] = at
            at += widths.get(column, 0) + 2 * (column in widths)
        for row in self.rows:
            for number in range(max((len(lines) for _, _, lines in row), default=0)):
                out: list[str] = []
                size = 0
                for column, _, lines in row:
                    if number < len(lines) and lines[number]:
                        gap = max(begins.get(column, size) - size, 2 if size else 0)
                        out.append(" " * gap + lines[number])
                        size += gap + len(lines[number])
                yield "".join(out)


class Page:
    """Builds the tree of a page and its text along with it."""

    def __init__(self):
        self.open: list[str] = []
        self.count: dict[str, int] = {}  # how many of a name are open
        self.hidden_at: int | None = None  # depth of the outermost hidden element
        self.flows = [Flow()]
        self.grids: list[Grid] = []
        self.numbers: list[int | None] = []  # of the open lists: the last number, None if bulleted
        self.spans: list[tuple[int, int]] = []

    # The tree.

    def start(self, name: str, attributes: str) -> None:
        if name in ("html", "body"):
            if name == "body":
                self.close_all("head", set())
            return
        if "head" in self.count and name not in HEAD_PARTS and name != "head":
            self.close_all("head", set())
        if name in ENDS_PARAGRAPH and "p" in self.count:
            self.close_all("p", {"table", "td", "th", "caption"})
        if name in CLOSES:
            self.close_names(*CLOSES[name])
        if name in TABLE_PARTS and not self.grids:
            return  # a part of no table
        if name in ("td", "th") and self.open[-1] != "tr":
            self.start("tr", "")
        self.push(name, attributes)
        if name in VOID:
            self.pop()

    def close_names(self, names: set[str], bounds: set[str]) -> None:
        """Close from the outermost of the names that is open within the bounds."""
        if not any(name in self.count for name in names):
            return
        at, found = len(self.open) - 1, None
        while at >= 0 and self.open[at] not in bounds:
            if self.open[at] in names:
                found = at
            at -= 1
        while found is not None and len(self.open) > found:
            self.pop()

    def close_all(self, name: str, bounds: set[str]) -> None:
        self.close_names({name}, bounds)

    def end(self, name: str) -> None:
        if name == "br":
            return self.start("br", "")
        if name not in self.count:
            return
        bounds = {"table"} if name != "table" else set()
        if name not in TABLE_PARTS | {"table"}:
            bounds |= {"td", "th", "caption"}
        at = len(self.open) - 1
        while at >= 0 and self.open[at] != name:
            if self.open[at] in bounds:
                return
            at -= 1
        while at >= 0 and len(self.open) > at:
            self.pop()

    # The layout.

    def push(self, name: str, attributes: str) -> None:
        self.open.append(name)
        self.count[name] = self.count.get(name, 0) + 1
        if self.hidden_at is None and (name in HIDDEN or attributes and hides(name, attributes)):
            self.hidden_at = len(self.open)
        if name in ("td", "th", "caption"):
            given = dict_of(attributes) if name != "caption" and attributes else {}
            self.spans.append((span(given.get("colspan")), span(given.get("rowspan"))))
            self.flows.append(Flow())
        elif name == "table":
            if self.hidden_at is None:
                self.flows[-1].block(True)
            self.grids.append(Grid())
        elif name == "tr":
            self.grids[-1].row()
        elif self.hidden_at is None:
            self.opened(name, attributes)
        if name in ("ol", "ul", "menu", "dir"):
            first = dict_of(attributes).get("start", "1") if attributes else "1"
            first = int(first) if re.fullmatch(r"-?\d{1,9}", first) else 1
            self.numbers.append(first - 1 if name == "ol" else None)

    def opened(self, name: str, attributes: str) -> None:
        flow = self.flows[-1]
        if name == "br":
            flow.line(force=True)
        elif name == "li":
            flow.line()
            mark = "- "
            if self.numbers and self.numbers[-1] is not None:
                self.numbers[-1] += 1
                mark = f"{self.numbers[-1]}. "
            # Items of very deep lists stop moving to the right.
            indent = min(flow.marks[-1][1], WIDEST) if flow.marks else 0
            flow.marks.append([" " * indent + mark, indent + len(mark)])
        elif name in BLOCKS:
            nested = name in ("ul", "ol", "menu", "dir") and flow.marks
            flow.block(name in SPACED and not nested)
            if name == "dd":
                flow.marks.append(["  ", 2])

    def pop(self) -> None:
        name = self.open.pop()
        self.count[name] -= 1
        if not self.count[name]:
            del self.count[name]
        shown = self.hidden_at is None
        if self.hidden_at is not None and self.hidden_at > len(self.open):
            self.hidden_at = None
        if name in ("ol", "ul", "menu", "dir"):
            self.numbers.pop()
        if name in ("td", "th", "caption"):
            lines = self.flows.pop().finished()
            columns, rows = self.spans.pop()
            if name == "caption":
                self.add_lines(lines)
            else:
                self.grids[-1].cell(lines, columns, rows)
        elif name == "table":
            self.add_lines(self.grids.pop().lines())
            if shown:
                self.flows[-1].block(True)
        elif shown and name != "tr":
            flow = self.flows[-1]
            if name in ("li", "dd"):
                flow.line()
                if flow.marks:
                    flow.marks.pop()
            elif name in BLOCKS:
                nested = name in ("ul", "ol", "menu", "dir") and flow.marks
                flow.block(name in SPACED and not nested)

    def add_lines(self, lines) -> None:
        flow = self.flows[-1]
        flow.line()
        for line in lines:
            flow.parts.append(line)
            flow.line(force=True)

    def text(self, value: str) -> None:
        if self.hidden_at is not None:
            if "head" not in self.count or self.open[-1] != "head" or not value.strip(_WHITE):
                return
            self.close_all("head", set())  # text ends the head
            if self.hidden_at is not None:
                return
        if "&" in value:
            value = html.unescape(value)
        if "pre" in self.count or "textarea" in self.count:
            self.flows[-1].kept_text(value)
        elif self.open and self.open[-1] in ("table", "tr", "tbody", "thead", "tfoot"):
            if value.strip(_WHITE):
                self.flows[-1].text(value)  # stray text goes before its table
        else:
            self.flows[-1].text(value)

    def result(self) -> str:
        while self.open:
            self.pop()
        return "\n".join(self.flows[0].finished())


def dict_of(attributes: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def hides(name: str, attributes: str) -> bool:
    """Whether an element's own attributes hide it."""
    lower = attributes.lower()
    if "hidden" not in lower and "none" not in lower and "collapse" not in lower:
        return False
    given = dict_of(attributes)
    if "hidden" in given or (name == "input" and given.get("type", "").lower() == "hidden"):
        return True
    return bool(_HIDING.search(given.get("style", "")))


def span(value: str | None) -> int:
    """Columns or rows that a cell spans."""
    return min(max(int(value), 1), _SPANS) if value and re.fullmatch(r"\d{1,9}", value) else 1


def page_text(source: str) -> str:
    """The laid-out visible text of a page."""
    page, at, end = Page(), 0, len(source)
    while at < end:
        mark = source.find("<", at)
        if mark < 0:
            mark = end
        if mark > at:
            page.text(source[at:mark])
        if mark == end:
            break
        if source.startswith("<!--", mark):
            stop = source.find("-->", mark + 4)
            at = end if stop < 0 else stop + 3
            continue
        found = _TAG.match(source, mark + 1) or _LOOSE_TAG.match(source, mark + 1)
        if found:
            slash, name, attributes = found.groups()
            name, at = name.lower(), found.end()
            if slash:
                page.end(name)
                continue
            page.start(name, attributes)
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[ \t\n\f\r/>])", re.I).search(source, at)
                stop = close.start() if close else end
                page.text(source[at:stop])
                page.end(name)
                at = stop
        elif source[mark + 1 : mark + 2] in ("!", "?", "/"):
            stop = source.find(">", mark)
            at = end if stop < 0 else stop + 1
        elif source[mark + 1 : mark + 2].isalpha() and source.find(">", mark) < 0:
            break  # a tag that never ends
        else:
            page.text("<")
            at = mark + 1
    return page.result()


def rendered(df: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """Add the laid-out text of each page; the page itself is left out, all else stays."""
    kept = [c for c in df.columns if c.lower() not in (page.lower(), text.lower())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            texts = [None if v is None else page_text(v) for v in batch[page].to_pylist()]
            made = pa.array(texts, pa.string())
            yield pa.record_batch([*(batch[c] for c in kept), made], [*kept, text])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(text, T.StringType())])
    return df.select(*kept, page).mapInArrow(run, schema)
