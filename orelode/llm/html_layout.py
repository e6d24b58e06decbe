"""Visible text of HTML pages, laid out as a browser's text view would be.

A scanner feeds a tree builder that opens and closes the tags which authors may leave
out. The tree is then walked once: hidden subtrees are passed over, blocks begin new
lines, paragraphs and headings keep blank lines around them, list items get markers and
indents, and the cells of a table are padded to columns. Nothing visible is dropped.

Neither building nor walking recurses, so nesting may be as deep as the text is long.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title template".split())
HIDDEN = frozenset(
    "head title script style template noscript noembed noframes iframe canvas audio video datalist "
    "map col colgroup param source track meta link base area annotation annotation-xml mphantom".split()
)
#: Of a drawing, the contents of its texts and of embedded HTML are shown, but not what it only defines.
SHOWN = frozenset(["text", "foreignobject"])
DEFINED = frozenset("desc defs metadata symbol clippath mask pattern marker".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol menu dl table figure hr fieldset xmp listing".split())
LINES = frozenset(
    "html body div section article aside nav header footer main address center dt dd li form details summary figcaption "
    "legend caption tr optgroup option dir hgroup search dialog".split()
)
#: An opening tag ends what is open of the second set, up to an element of the third.
CELLS, ROWS, GROUPS = frozenset(["td", "th"]), frozenset(["tr"]), frozenset(["tbody", "thead", "tfoot"])
ENDS = {
    "li": (frozenset(["li", "p"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (CELLS, frozenset(["table", "tr"])),
    "th": (CELLS, frozenset(["table", "tr"])),
    "tr": (CELLS | ROWS | {"caption", "colgroup"}, frozenset(["table"])),
    **dict.fromkeys(GROUPS, (CELLS | ROWS | GROUPS | {"caption", "colgroup"}, frozenset(["table"]))),
    "body": (frozenset(["head"]), frozenset()),
}
#: A block's opening tag ends an open paragraph, but not one outside of these.
P_SCOPE = frozenset(["button", "td", "th", "caption", "table", "object", "li", "dd", "dt"])
TABLE_PARTS = frozenset(["table", "tr", "td", "th", "caption"]) | GROUPS

TAG = re.compile(
    r"""<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
CONCEALED = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)
SPACES = re.compile(r"[ \t\n\f\r]+")
#: Cells longer than this do not widen their column.
WIDEST = 60
MOST_SPAN = 1000


@dataclass(slots=True)
class Node:
    tag: str
    attributes: str = ""
    children: list = field(default_factory=list)

    def attribute(self, name: str) -> str | None:
        """The value of an attribute, '' if it has none; None if it is not there."""
        if name not in self.attributes.lower():
            return None
        for key, value in ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return html.unescape(value.strip("\"'"))
        return None

    def hidden(self) -> bool:
        if self.tag in HIDDEN:
            return True
        if not self.attributes:
            return False
        style = self.attribute("style")
        return bool(style and CONCEALED.search(style)) or self.attribute("hidden") is not None


def parse(page: str) -> Node:
    """The tree of a page, with implied tags. Anything is a page; a tag without end is dropped."""
    root = Node("#root")
    open_, count, place = [root], {"#root": 1}, 0

    def push(node: Node) -> None:
        open_[-1].children.append(node)
        open_.append(node)
        count[node.tag] = count.get(node.tag, 0) + 1

    def pop() -> str:
        tag = open_.pop().tag
        count[tag] -= 1
        return tag

    def end(tags: frozenset, bounds: frozenset) -> None:
        """Close the outermost open element of ``tags`` inside of ``bounds``."""
        if not any(count.get(t) for t in tags):
            return
        upto = None
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in bounds:
                break
            if open_[i].tag in tags:
                upto = i
                if tags is not CELLS and open_[i].tag == "p":
                    break
        while upto is not None and len(open_) > upto:
            pop()

    def text(start: int, stop: int) -> None:
        if stop > start:
            part = page[start:stop]
            open_[-1].children.append(html.unescape(part) if "&" in part else part)

    # Beyond the last ">" no tag can end, so nothing there is tried.
    limit = page.rfind(">") + 1
    while m := TAG.search(page, place, max(place, limit)):
        text(place, m.start())
        place = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing = name.lower(), m[1] or m[4]
        if closing:
            if count.get(tag) and tag != "#root":
                bounds = frozenset() if tag in TABLE_PARTS else CELLS | {"caption"}
                bounds = bounds | {"table"} if tag != "table" else bounds
                for i in range(len(open_) - 1, 0, -1):
                    if open_[i].tag == tag:
                        while len(open_) > i:
                            pop()
                        break
                    if open_[i].tag in bounds:
                        break
            continue
        attributes = m[3] or m[6] or ""
        if tag in ENDS:
            end(*ENDS[tag])
        elif (tag in PARAGRAPHS or tag in LINES) and count.get("p"):
            end(frozenset(["p"]), P_SCOPE)
        if tag in CELLS and count.get("table") and open_[-1].tag != "tr":
            if open_[-1].tag == "table":
                push(Node("tbody"))
            if open_[-1].tag in GROUPS:
                push(Node("tr"))
        elif tag == "tr" and open_[-1].tag == "table":
            push(Node("tbody"))
        node = Node(tag, attributes)
        foreign = tag in ("svg", "math") or (count.get("svg") or count.get("math")) and not count.get("foreignobject")
        if tag in VOID or foreign and attributes.endswith("/"):
            open_[-1].children.append(node)
        elif tag in RAW:
            open_[-1].children.append(node)
            stop = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(page, place)
            raw = page[place : stop.start() if stop else len(page)]
            if tag == "textarea":
                raw = re.sub(r"\r\n?", "\n", raw).removeprefix("\n")
            node.children.append(html.unescape(raw) if tag in ("title", "textarea") else raw)
            place = stop.start() if stop else len(page)
            if stop:
                after = page.find(">", stop.end())
                place = after + 1 if after >= 0 else len(page)
        elif not attributes.endswith("/") or tag not in ("path", "use", "g", "rect", "circle"):
            push(node)
    # What looks like a tag but never ends is no text.
    broken = re.compile(r"<[a-zA-Z/!?]").search(page, place)
    text(place, broken.start() if broken else len(page))
    return root


class Layout:
    """Lines under construction. A table cell has a layout of its own."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.indents: list[str] = []
        self.marker, self.gap = "", 0

    def text(self, part: str, kept: bool) -> None:
        if kept:
            first, *others = part.split("\n")
            self.parts.append(first)
            for line in others:
                self.flush(True)
                self.parts.append(line)
            return
        part = SPACES.sub(" ", part)
        if not self.parts or self.parts[-1].endswith(" "):
            part = part.removeprefix(" ")
        if part:
            self.parts.append(part)

    def flush(self, empty: bool = False) -> None:
        line = "".join(self.parts).rstrip()
        self.parts.clear()
        if not line and not empty:
            return
        if self.gap > 1 and self.lines:
            self.lines.append("")
        self.gap = 0
        indent = "".join(self.indents)
        if self.marker:
            indent, self.marker = indent[: len(indent) - len(self.marker)] + self.marker, ""
        self.lines.append((indent + line).rstrip())

    def block(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)

    def finish(self) -> list[str]:
        self.flush()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def render(page: str | None) -> str:
    """All visible text of a page; '' for null."""
    layouts, lists, tables, kept = [Layout()], [], [], 0
    #: Whether text shows, for the page and each element that decides it anew in a drawing.
    shows = [True]
    work: list[tuple[Node | str, bool]] = [(parse(page or ""), False)]
    while work:
        node, leaving = work.pop()
        here = layouts[-1]
        if isinstance(node, str):
            if shows[-1]:
                here.text(node, kept > 0)
            continue
        tag = node.tag
        drawn = tag == "svg" or tag in SHOWN and (len(shows) > 1)
        gap = 2 if tag in PARAGRAPHS else 1 if tag in LINES or tag == "textarea" or drawn and tag != "svg" else 0
        if leaving:
            if tag in CELLS and tables:
                cell = layouts.pop().finish()
                spans = [_span(node, "colspan"), _span(node, "rowspan")]
                tables[-1][-1].append((cell, *spans))
                continue
            if tag == "table":
                here.flush()
                for line in _aligned(tables.pop()):
                    here.parts.append(line)
                    here.flush(True)
            elif tag in ("pre", "listing", "xmp", "textarea"):
                kept -= 1
            elif tag in ("ul", "ol", "menu", "dir") and lists:
                lists.pop()
                if lists:
                    gap = 1
            if drawn:
                shows.pop()
            if gap:
                here.block(gap)
            if tag in ("li", "dd", "blockquote") and here.indents:
                here.indents.pop()
                here.marker = ""
            continue
        if node.hidden() or len(shows) > 1 and tag in DEFINED:
            continue
        if tag == "br":
            here.flush(True)
            continue
        if tag in VOID and tag != "hr":
            if tag == "input" and node.attribute("type") in ("submit", "button", "reset"):
                here.text(node.attribute("value") or "", False)
            continue
        if gap:
            here.block(1 if lists and tag in ("ul", "ol", "menu", "dir") else gap)
        if tag in ("ul", "ol", "menu", "dir"):
            start = node.attribute("start") or ""
            number = int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0
            lists.append(number if tag == "ol" else None)
        elif tag == "li":
            if lists and lists[-1] is not None:
                lists[-1] += 1
                here.marker = f"{lists[-1]}. "
            else:
                here.marker = "- "
            here.indents.append(" " * len(here.marker))
        elif tag in ("dd", "blockquote"):
            here.indents.append("    " if tag == "dd" else "  ")
        elif tag in ("pre", "listing", "xmp", "textarea"):
            kept += 1
        elif tag == "table":
            tables.append([])
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in CELLS and tables:
            if not tables[-1]:
                tables[-1].append([])
            layouts.append(Layout())
        if drawn:
            shows.append(tag != "svg")
        work.append((node, True))
        work.extend((child, False) for child in reversed(node.children))
    return "\n".join(layouts[0].finish())


def title(page: str | None) -> str:
    """The text of the first title element."""
    m = re.search(r"<title[^>]*>(.*?)(?:</title|\Z)", page or "", re.IGNORECASE | re.DOTALL)
    return SPACES.sub(" ", html.unescape(m[1])).strip() if m else ""


def extract(df: DataFrame, page: str = "html", keep: list[str] = ("page_id",)) -> DataFrame:
    """``keep`` columns, title, text and n_lines of each page.

    A null or empty page has the title '', the text '' and 0 lines. Repeated rows are
    rendered one by one; other columns of ``df`` are not read.
    """
    rows, names = df.select(*keep, F.col(page).alias("__page")), list(keep)

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                pages = part.column(len(names)).to_pylist()
                texts = [render(p) for p in pages]
                lines = [t.count("\n") + 1 if t else 0 for t in texts]
                out = [pa.array(list(map(title, pages)), pa.string()), pa.array(texts, pa.string()), pa.array(lines, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(names)], *out], names=[*names, "title", "text", "n_lines"]
                )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(lay_out, ", ".join([*kept, "title string", "text string", "n_lines long"]))


def _span(node: Node, name: str) -> int:
    value = node.attribute(name) or ""
    return min(max(1, int(value)), MOST_SPAN) if re.fullmatch(r"\d{1,9}", value) else 1


def _aligned(rows: list[list[tuple[list[str], int, int]]]) -> Iterator[str]:
    """The lines of a table: cells padded to columns, two blanks apart."""
    grid, busy = [], {}
    for row in rows:
        cells, column = {}, 0
        for lines, across, down in row:
            while busy.get(column, 0) > 0:
                column += 1
            cells[column] = lines
            for c in range(column, column + across):
                busy[c] = max(busy.get(c, 0), down)
            column += across
        grid.append(cells)
        busy = {c: n - 1 for c, n in busy.items() if n > 1}
    widths: dict[int, int] = {}
    for cells in grid:
        for c, lines in cells.items():
            widths[c] = max([widths.get(c, 0), *(len(x) for x in lines if len(x) <= WIDEST)])
    for cells in grid:
        for i in range(max(map(len, cells.values()), default=0)):
            line, column = "", 0
            for c in sorted(widths):
                own = cells.get(c, [])
                line = line.ljust(column) + (own[i] if i < len(own) else "")
                column += widths[c] + 2
                if len(line) > column - 2:
                    line += "  "
            yield line.rstrip()
