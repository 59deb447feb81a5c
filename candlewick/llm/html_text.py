"""Layout-aware rendering of HTML to plain text.

A tree is built with the tags that HTML implies (ends of paragraphs, list
items, cells; whatever is still open). Visibility rules leave out what a reader
doesn't see. The rest is laid out: blocks with their spacing, numbered and
bulleted lists, preformatted text, tables with aligned columns.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "head script style template noscript title datalist iframe object canvas audio video".split()
)
#: What head holds; any other start tag ends it.
HEAD = frozenset("base basefont bgsound link meta title style script template noscript noframes".split())
#: Inside pictures and formulas, what is only described, defined or annotated.
SILENT = {
    "svg": frozenset("desc metadata defs symbol clippath mask pattern marker".split()),
    "math": frozenset(["annotation", "annotation-xml"]),
}
#: Blocks with a blank line around them, and those without.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr fieldset".split())
BLOCKS = SPACED | frozenset(
    "html body div article section nav header footer main aside address form figcaption details summary legend "
    "li dt dd tr td th thead tbody tfoot caption center menu hgroup search option".split()
)
#: A start tag -> open elements that it ends, and elements that stop the search.
_CELL, _ROW, _PART = frozenset(["td", "th"]), frozenset(["tr"]), frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"])
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (_CELL, frozenset(["table", "tr"])),
    "th": (_CELL, frozenset(["table", "tr"])),
    "tr": (_CELL | _ROW | frozenset(["caption", "colgroup"]), frozenset(["table"])),
    "thead": (_CELL | _ROW | _PART, frozenset(["table"])),
    "tbody": (_CELL | _ROW | _PART, frozenset(["table"])),
    "tfoot": (_CELL | _ROW | _PART, frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select", "datalist"])),
}
#: End tags don't reach beyond these.
SCOPES = frozenset("table td th caption html body".split())
#: Elements open at once in the tree. Those below are followed by name and visibility
#: only: their text goes to the deepest element in the tree, with line breaks for blocks.
DEEPEST = 150
#: Columns wider than this aren't padded.
WIDEST = 60
_NONE = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
#: Inputs whose value isn't shown as text.
VALUELESS = frozenset("hidden password checkbox radio file image range color".split())


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.kids = tag, attrs, []


class Tree(HTMLParser):
    """Builds the tree; ``root`` is complete after ``close()``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.deep: list[tuple[str, bool | None]] = []  # open elements below: tag, shown (None: nor is anything inside)

    def handle_starttag(self, tag, attrs):
        if tag == "body" or tag == "html":
            self._pop_to("head")
            return
        if self.open[-1].tag == "head" and tag not in HEAD:
            self._pop_to("head")
        if tag in BLOCKS and tag != "option":
            self._end({"p"}, SCOPES)  # a block ends a paragraph
            if tag not in _CELL | _ROW | _PART:
                self._pop_to("head")
        if tag in ENDS:
            self._end(*ENDS[tag])
        node = Node(tag, {k: v or "" for k, v in attrs})
        if any(tag in SILENT[n] for n in self._names() if n in SILENT):
            node.attrs["hidden"] = ""
        if len(self.open) < DEEPEST:
            self.open[-1].kids.append(node)
            if tag not in VOID:
                self.open.append(node)
            return
        below = self.deep[-1][1] if self.deep else visibility(self.open[1:])
        if tag in VOID:
            if not self._unseen():
                self.open[-1].kids.append(node)
            return
        shown = visibility([node], below) if below is not None and visible(node) else None
        if shown is not None:
            self._break(tag)
        self.deep.append((tag, shown))

    def _names(self):
        yield from (n.tag for n in self.open)
        yield from (tag for tag, _ in self.deep)

    def _unseen(self) -> bool:
        """Whether text at this place, below the tree, is not seen."""
        return bool(self.deep) and self.deep[-1][1] is not True

    def _break(self, tag: str) -> None:
        if tag in BLOCKS:
            self.open[-1].kids.append(Node(tag if tag in SPACED else "div", {}))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        # pictures and formulas have empty elements; HTML hasn't
        if tag not in VOID and any(n in SILENT for n in self._names()):
            if self.deep:
                self.deep.pop()
            elif self.open[-1].tag == tag and not self.open[-1].kids:
                self.open.pop()

    def handle_endtag(self, tag):
        if tag not in ("body", "html"):
            self._pop_to(tag)

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._pop_to("head")
        if not self.deep:
            self.open[-1].kids.append(data)
        elif not self._unseen():
            # shown whatever the tree's elements say; inside one without layout it
            # isn't reached
            shown = Node("span", {"style": "visibility:visible"})
            shown.kids.append(data)
            self.open[-1].kids.append(shown)

    def _cut(self, at: int) -> None:
        """Close the open element number ``at`` (those below count on) and all inside."""
        if at < len(self.open):
            self.deep.clear()
            del self.open[at:]
            return
        ended = self.deep[at - len(self.open) :]
        del self.deep[at - len(self.open) :]
        for tag, shown in reversed(ended):
            if shown is not None:
                self._break(tag)

    def _end(self, tags, stop):
        """Close the outermost open element of ``tags`` inside the nearest of ``stop``."""
        found, names = None, list(self._names())
        for i in range(len(names) - 1, 0, -1):
            if names[i] in tags:
                found = i
            elif names[i] in stop:
                break
        if found:
            self._cut(found)

    def _pop_to(self, tag):
        names = list(self._names())
        for i in range(len(names) - 1, 0, -1):
            if names[i] == tag:
                self._cut(i)
                return
            if names[i] in SCOPES and tag not in SCOPES and tag not in _ROW | _PART | {"table"}:
                return


def visible(node: Node) -> bool:
    """Whether the element takes part in the layout at all."""
    if node.tag in UNSEEN or "hidden" in node.attrs or _NONE.search(node.attrs.get("style", "")):
        return False
    return not (node.tag == "dialog" and "open" not in node.attrs)


def visibility(path: list[Node], shown: bool = True) -> bool:
    """Whether text is shown inside these nested elements: the innermost element that
    says so decides."""
    for node in path:
        for word in _VISIBILITY.findall(node.attrs.get("style", ""))[-1:]:
            shown = word.lower() == "visible"
    return shown


def chosen(select: Node) -> list[Node]:
    """The options that a reader sees: all of a list box, else the last selected
    one, or the first that can be chosen."""
    options = []

    def collect(node: Node, off: bool):
        for kid in node.kids:
            if isinstance(kid, Node) and visible(kid):
                if kid.tag == "option":
                    options.append((kid, off or "disabled" in kid.attrs))
                else:
                    collect(kid, off or "disabled" in kid.attrs)

    collect(select, False)
    if "multiple" in select.attrs or re.fullmatch(r"\s*0*([2-9]|[1-9]\d+)\s*", select.attrs.get("size", "")):
        return [o for o, _ in options]
    return [o for o, _ in options if "selected" in o.attrs][-1:] or [o for o, off in options if not off][:1]


class Layout:
    """Lines of text, with blank lines between spaced blocks."""

    def __init__(self, shown: bool = True):
        self.shown = shown
        self.lines: list[str] = []
        self.line: list[str] = []
        self.indent = ""
        self.marker: str | None = None
        self.blank = False

    def text(self, data: str, pre: bool) -> None:
        if not self.shown:
            return
        if pre:
            first, *rest = data.split("\n")
            self._add(first)
            for part in rest:
                self.end_line(keep=True)
                self._add(part)
            return
        words = data.split()
        if data[:1].isspace() and self.line and not self.line[-1].endswith(" "):
            self.line.append(" ")
        if words:
            self._add(" ".join(words) + (" " if data[-1].isspace() else ""))

    def _add(self, part: str) -> None:
        if part:
            self.line.append(part)

    def end_line(self, keep: bool = False) -> None:
        text = "".join(self.line).rstrip()
        if text or (keep and self.lines):
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            start = self.indent
            if self.marker is not None:
                start = self.indent[: len(self.indent) - len(self.marker)] + self.marker
                self.marker = None
            self.lines.append((start + text).rstrip())
        self.line = []

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.blank = self.blank or spaced

    def walk(self, node: Node, pre: bool = False, depth: int = 0) -> None:
        number = 0
        if node.tag == "ol":
            number = int(node.attrs["start"]) if re.fullmatch(r"-?\d{1,9}", node.attrs.get("start", "")) else 1
        for kid in node.kids:
            if isinstance(kid, str):
                self.text(kid, pre)
                continue
            if not visible(kid):
                continue
            outer, self.shown = self.shown, visibility([kid], self.shown)
            number = self._element(node, kid, pre, depth, number)
            self.shown = outer

    def _element(self, node: Node, kid: Node, pre: bool, depth: int, number: int) -> int:
        tag = kid.tag
        if tag == "br":
            self.end_line(keep=True)
        elif tag == "table":
            self.block(True)
            for line in table(kid, self.shown):
                self.line = [line]
                self.end_line(keep=True)
            self.block(True)
        elif tag == "li":
            marker = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            self._inside(kid, marker, pre, depth)
        elif tag == "dd" or tag == "blockquote":
            self._inside(kid, None, pre, depth)
        elif tag == "details" and "open" not in kid.attrs:
            summary = next((k for k in kid.kids if isinstance(k, Node) and k.tag == "summary"), None)
            self.block(False)
            if summary is not None and visible(summary):
                self.walk(summary, pre, depth + 1)
            self.block(False)
        elif tag == "input":
            if kid.attrs.get("type", "").lower() not in VALUELESS:
                self.text(kid.attrs.get("value", ""), False)
        elif tag == "select":
            of = chosen(kid)
            for option in of:
                if len(of) > 1:
                    self.block(False)
                self.walk(option, pre, depth + 1)
            if len(of) > 1:
                self.block(False)
        elif tag in BLOCKS:
            spaced = tag in SPACED and not (tag in ("ul", "ol") and node.tag == "li")
            self.block(spaced)
            self.walk(kid, pre or tag == "pre", depth + 1)
            self.block(spaced)
        else:
            if tag == "textarea" or tag == "text":  # text of a picture
                self.block(False)
            self.walk(kid, pre or tag == "textarea", depth + 1)
            if tag == "text":
                self.block(False)
        return number

    def _inside(self, kid: Node, marker: str | None, pre: bool, depth: int) -> None:
        self.block(kid.tag == "blockquote")
        indent, outer = self.indent, self.marker
        self.indent += " " * (len(marker) if marker else 2)
        self.marker = marker
        self.walk(kid, pre, depth + 1)
        self.block(kid.tag == "blockquote")
        self.indent, self.marker = indent, None if self.marker == marker else outer


def render(node: Node, shown: bool = True) -> list[str]:
    out = Layout(shown)
    out.walk(node)
    out.end_line()
    return out.lines


def table(node: Node, shown: bool = True) -> list[str]:
    """Lines of a table: a caption, then rows whose cells line up; a cell of
    several lines takes several, and a cell of several rows keeps its columns in
    all of them. Text outside cells stands before them."""
    before, rows = [], []

    def collect(part: Node, shown: bool):
        loose = Node("", {})
        for kid in part.kids:
            if isinstance(kid, str) or kid.tag not in _ROW | _PART | _CELL:
                loose.kids.append(kid)
                continue
            if not visible(kid):
                continue
            inside = visibility([kid], shown)
            if kid.tag == "tr" or kid.tag in _CELL:
                cells = [kid] if kid.tag in _CELL else [c for c in kid.kids if isinstance(c, Node) and c.tag in _CELL and visible(c)]
                other = [c for c in kid.kids if isinstance(c, str) or c.tag not in _CELL] if kid.tag == "tr" else []
                extra = Node("", {})
                extra.kids = other
                before.extend(render(extra, inside))
                if cells:
                    rows.append([(render(c, visibility([c], inside)), c.attrs) for c in cells])
            elif kid.tag == "caption":
                before.extend(render(kid, inside))
            elif kid.tag != "colgroup":
                collect(kid, inside)
        before.extend(render(loose, shown))

    collect(node, shown)
    widths: dict[int, int] = {}
    placed = []
    taken: dict[int, int] = {}  # column -> rows that a cell above still holds it for
    for row in rows:
        at, cells, held = 0, [], {}
        for lines, attrs in row:
            while taken.get(at):
                at += 1
            across, down = _span(attrs, "colspan"), _span(attrs, "rowspan")
            cells.append((at, across, lines))
            if across == 1:
                width = max(map(len, lines), default=0)
                if width <= WIDEST:
                    widths[at] = max(widths.get(at, 0), width)
            if down > 1:
                held |= dict.fromkeys(range(at, at + across), down - 1)
            at += across
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | held
        placed.append(cells)
    out = before
    starts = lambda n: sum(widths.get(c, 0) + 2 for c in range(n))
    for cells in placed:
        for i in range(max(1, max((len(lines) for *_, lines in cells), default=1))):
            line, end = "", 0
            for at, across, lines in cells:
                # from where the cell before should have ended
                line += " " * (starts(at) - end)
                end = starts(at + across)
                line += (lines[i] if i < len(lines) else "").ljust(end - starts(at) - 2) + "  "
            if line.strip():
                out.append(line.rstrip())
    return out


def _span(attrs: dict, name: str) -> int:
    value = attrs.get(name, "")
    return int(value) if re.fullmatch(r"[1-9]\d{0,2}", value) else 1


def text_of(html: str | None) -> str:
    tree = Tree()
    tree.feed((html or "").replace("\0", ""))
    tree.close()
    return "\n".join(render(tree.root)).strip("\n")


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """All columns of ``pages`` but ``column``, plus ``text`` (a column of that
    name is replaced). Null and empty pages have empty text; rows are rendered
    one by one, so repeated rows, ties and null keys need no care."""

    own = "__html"
    while own in pages.columns:
        own += "_"

    def look(batches):
        for batch in batches:
            at = batch.schema.get_field_index(own)
            texts = [text_of(h) for h in batch.column(at).to_pylist()]
            arrays = [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[n for i, n in enumerate(batch.schema.names) if i != at] + ["text"])

    held = pages.withColumnRenamed(column, own)
    rest = held.drop("text")
    if column == "text":
        rest = held
    return rest.mapInArrow(look, rest.drop(own).withColumn("text", F.lit("")).schema)
