"""HTML to text by layout: a tree with implied tags, visibility rules, blocks and tables.

Start and end tags build a tree; tags that HTML lets authors leave out are implied (a row
ends the row before, a block ends an open paragraph, what can't stand in a head ends it). What a browser hides is left out:
heads, scripts, templates, ``hidden``, closed dialogs, and what inline styles and the page's
own style sheets hide (``styles``); ``visibility`` is inherited and may return inside. All other text,
with formulas, text in drawings and what an object falls back to, is emitted: blocks on lines of their own with a blank line around paragraphs, headings, lists
and tables, list items with marks and indents, table cells in aligned columns,
preformatted text as it is. Nothing is dropped as boilerplate.

Null and empty pages, and pages without visible text, give empty text. Elements may nest to
any depth. A cell that spans rows keeps its columns in all of them, its text is in the first;
spans are bounded as in HTML, at 1,000 columns. Columns wider than ``WIDEST`` aren't padded. Repeated rows get equal results, an empty
table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Generator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.llm.common import by_batch, prepare
from faregauge.llm.styles import Styles, on_screen

WIDEST = 40
# Greatest spans in HTML.
MOST_COLUMNS, MOST_ROWS = 1000, 65534

# Fixed sets of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style template iframe canvas audio video datalist noembed noframes".split())
# Parts of drawings and formulas that define or describe and are not drawn.
UNDRAWN = {"svg": frozenset("defs desc metadata symbol".split()), "math": frozenset("annotation annotation-xml".split())}
# All that may stand in a head, which any other start tag ends.
IN_HEAD = frozenset("head base basefont bgsound link meta title script style template noscript noframes".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset details hr".split())
BLOCKS = SPACED | frozenset(
    "html body div section article aside header footer nav main address form li dt dd tr caption thead tbody tfoot"
    " figcaption legend summary hgroup center menu dir option optgroup search".split()
)
# An arriving element closes these open ones, up to the nearest of the bounds.
CLOSES = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th caption colgroup", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "thead": ("thead tbody tfoot tr td th caption colgroup", "table"),
    "tbody": ("thead tbody tfoot tr td th caption colgroup", "table"),
    "tfoot": ("thead tbody tfoot tr td th caption colgroup", "table"),
    "option": ("option", "select optgroup"),
    "optgroup": ("option optgroup", "select"),
}
CLOSES = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in CLOSES.items()}
_P_BOUNDS = frozenset("table td th li caption button object html body".split())
_ENDS_P = BLOCKS - frozenset("html body li tr dt dd caption thead tbody tfoot option optgroup".split())

_SPACE = re.compile(r"[ \t\n\r\f]+")
_LETTER = re.compile(r"[^\r\n]")


class Node:
    """An element; ``never`` shown whatever styles say, else ``hidden`` and ``visible`` by them."""

    __slots__ = ("tag", "attributes", "children", "never", "hidden", "visible")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []
        self.never = tag in HIDDEN
        self.hidden = self.never or "hidden" in attributes or (tag == "dialog" and "open" not in attributes)
        self.visible = True


class Tree(HTMLParser):
    """Builds the tree of a page and collects its style sheets.

    The places of open elements are kept by name, so no tag has to search through them.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.styles = Styles()

    def _last(self, tag: str) -> int:
        places = self.places[tag]
        return places[-1] if places else 0

    def _end(self, at: int) -> None:
        """End the open element at a place, and all inside it."""
        while len(self.open) > at:
            self.places[self.open.pop().tag].pop()

    def _close(self, names: frozenset[str], bounds: frozenset[str]) -> None:
        """End the outermost open element of ``names`` inside the nearest of ``bounds``."""
        bound = max((self._last(b) for b in bounds if b not in names), default=0)
        found = [places[i] for n in names if (i := bisect_right(places := self.places[n], bound)) < len(places)]
        if found:
            self._end(min(found))

    def _in_head(self) -> bool:
        """Whether a head is open, and nothing in it that may hold other tags or text."""
        if len(self.open) == 1 or self.open[1].tag != "head":
            return False
        return len(self.open) - 1 == len(self.places["head"]) + len(self.places["noscript"])

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag not in IN_HEAD and self._in_head():
            self._end(1)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag in _ENDS_P:
            self._close(frozenset("p"), _P_BOUNDS)
        node = Node(tag, {k: v or "" for k, v in attrs})
        if any(tag in names and self.places[around] for around, names in UNDRAWN.items()):
            node.never = node.hidden = True
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places[tag].append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
        at = self._last(tag)
        # An inline end tag doesn't reach out of its cell.
        bound = 0 if tag in BLOCKS else max(map(self._last, ("td", "th", "table")))
        if at and at >= bound:
            self._end(at)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "style":
            if on_screen(self.open[-1].attributes.get("media", "")):
                self.styles.add(data)
        elif self._in_head() and data.strip(" \t\n\r\f"):
            self._end(1)
        self.open[-1].children.append(data)


def unwound(step: Generator):
    """Result of a generator that yields others and takes their results, without recursion."""
    steps, result = [step], None
    while steps:
        try:
            steps.append(steps[-1].send(result))
            result = None
        except StopIteration as end:
            steps.pop()
            result = end.value
    return result


class Page:
    """Renders a tree to lines; None in a list of lines asks for one blank line.

    Methods that go into children are generators for ``unwound``.
    """

    def lines(self, node: Node, pre: bool = False) -> Generator:
        out: list[str | None] = []
        run: list[str | None] = []
        yield self._flow(node, out, run, pre)
        self._end_line(out, run, pre)
        return out

    def _end_line(self, out: list, run: list, pre: bool) -> None:
        if not run:
            return
        parts, start = [], 0
        for i in [*(i for i, x in enumerate(run) if x is None), len(run)]:
            parts.append("".join(run[start:i]))
            start = i + 1
        run.clear()
        if pre:
            out += [line.rstrip() for part in parts for line in part.replace("\r\n", "\n").split("\n")]
            return
        made = [_SPACE.sub(" ", part).strip(" ").replace("\xa0", " ") for part in parts]
        if any(made):
            out += made if made[-1] else made[:-1]

    def _flow(self, node: Node, out: list, run: list, pre: bool) -> Generator:
        counter = int(start) if (start := node.attributes.get("start", "1")).isdigit() and len(start) < 10 else 1
        for child in node.children:
            if isinstance(child, str):
                # What is invisible takes its place.
                run.append(child if node.visible else _LETTER.sub(" ", child))
                continue
            if child.hidden:
                continue
            tag = child.tag
            if tag == "br":
                run.append(None)
            elif tag == "wbr" or tag not in BLOCKS:
                yield self._flow(child, out, run, pre)
                if tag in ("td", "th"):
                    run.append(" ")
            else:
                self._end_line(out, run, pre)
                if tag in SPACED:
                    out.append(None)
                if tag == "li":
                    mark = "- "
                    if node.tag == "ol":
                        value = child.attributes.get("value", "")
                        counter = int(value) if value.isdigit() and len(value) < 10 else counter
                        mark = f"{counter}. "
                        counter += 1
                    out += _indented(_tidy((yield self.lines(child, pre))), mark)
                elif tag == "dd":
                    out += _indented(_tidy((yield self.lines(child, pre))), "  ")
                elif tag == "blockquote":
                    out += _indented(_tidy((yield self.lines(child, pre))), "> ", "> ")
                elif tag == "table":
                    out += yield self._table(child, pre)
                elif tag == "hr":
                    out += ["---"] if child.visible else []
                elif tag == "pre":
                    out += yield self.lines(child, True)
                else:
                    yield self._flow(child, out, run, pre)
                    self._end_line(out, run, pre)
                if tag in SPACED:
                    out.append(None)

    def _rows(self, table: Node) -> tuple[list[tuple[Node, int]], list[Node | str]]:
        """Rows with the number of the row their group ends at, and all that is in none."""
        rows: list[tuple[Node, int]] = []
        rest: list[Node | str] = []
        single: list[Node] = []

        def end_group(group: list[Node]) -> None:
            end = len(rows) + len(group)
            rows.extend((r, end) for r in group)

        for child in table.children:
            if isinstance(child, str) or child.tag not in ("thead", "tbody", "tfoot", "tr"):
                rest.append(child)
            elif child.hidden:
                continue
            elif child.tag == "tr":
                single.append(child)
            else:
                end_group(single)
                single = []
                end_group([r for r in child.children if isinstance(r, Node) and r.tag == "tr" and not r.hidden])
                rest += [r for r in child.children if isinstance(r, str) or r.tag != "tr"]
        end_group(single)
        return rows, rest

    def _table(self, table: Node, pre: bool) -> Generator:
        """Text outside cells first, as browsers do, then the rows with columns aligned."""
        rows, rest = self._rows(table)
        out = yield self.lines(_around(table, rest), pre)
        grid: list[dict[int, list[str]]] = []
        taken: dict[int, int] = {}  # column: first row below the cell that spans into it
        for number, (row, end) in enumerate(rows):
            cells: dict[int, list[str]] = {}
            stray: list[Node | str] = []
            column = 0
            for child in row.children:
                if isinstance(child, str) or child.tag not in ("td", "th"):
                    stray.append(child)
                elif not child.hidden:
                    while taken.get(column, 0) > number:
                        column += 1
                    cells[column] = _tidy((yield self.lines(child, pre)))
                    wide = max(_span(child, "colspan", MOST_COLUMNS), 1)
                    high = _span(child, "rowspan", MOST_ROWS) or end - number
                    if high > 1:
                        taken |= dict.fromkeys(range(column, column + wide), min(number + high, end))
                    column += wide
            grid.append(cells)
            out += yield self.lines(_around(row, stray), pre)
        widths: dict[int, int] = {}
        for cells in grid:
            for c, cell in cells.items():
                widths[c] = max(widths.get(c, 0), *map(len, cell), 0)
        # Columns that no cell starts in have no width.
        columns = sorted(widths)
        widths = {c: w if w <= WIDEST else 0 for c, w in widths.items()}
        for cells in grid:
            shown = [c for c in columns if c <= max(cells, default=-1)]
            for i in range(max(map(len, cells.values()), default=0)):
                texts = ((cells[c][i] if c in cells and i < len(cells[c]) else "").ljust(widths[c]) for c in shown)
                out.append("  ".join(texts).rstrip())
        return out


def _around(node: Node, children: list[Node | str]) -> Node:
    """What is left of an element: some of its children, as visible as it is."""
    part = Node("div", {})
    part.children, part.visible = children, node.visible
    return part


def _span(cell: Node, name: str, most: int) -> int:
    span = cell.attributes.get(name, "1").strip()
    return min(int(span), most) if span.isascii() and span.isdigit() and len(span) < 19 else 1


def _tidy(lines: list[str | None]) -> list[str]:
    """Lines with requested blanks merged, none at the ends."""
    out: list[str] = []
    blank = False
    for line in lines:
        if line is None:
            blank = bool(out)
        else:
            if blank:
                out.append("")
            blank = False
            out.append(line)
    while out and not out[-1]:
        out.pop()
    while out and not out[0]:
        out.pop(0)
    return out


def _indented(lines: list[str], first: str, other: str | None = None) -> list[str]:
    other = " " * len(first) if other is None else other
    return [((first if i == 0 else other) + line).rstrip() for i, line in enumerate(lines)]


def page_text(html: str | None) -> str:
    """The visible text of one page."""
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    tree.styles.apply(tree.root)
    return "\n".join(_tidy(unwound(Page().lines(tree.root))))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, text) of every page; no shuffle, one page at a time in memory."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), F.col("html").cast("string"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array([page_text(h) for h in batch.column("html").to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([batch.column("page_id"), texts], ["page_id", "text"])

    return by_batch(rows, lambda: step, "page_id long, text string")
