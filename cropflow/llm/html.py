"""Operator 9: visible text of HTML pages, rendered with its layout.

A tree builder with implied tags (list items, definition terms, table parts,
paragraphs and options close their open siblings; cells get a row) and
visibility rules (scripts, styles, head, templates, ``hidden`` attributes,
``display:none`` and ``visibility:hidden`` styles, hidden inputs and comments are
not shown; of SVG the text elements and foreign objects are, of MathML the
tokens, of dialogs the open ones; a hidden element ends with its parent) feeds a renderer that keeps block spacing, list markers with
indentation, preformatted text, and tables whose cells are aligned in columns
(cells up to ``ALIGN_WIDTH`` characters set the column width; longer ones are kept
whole and run over).

Plan: one Arrow map over the pages, no shuffle; a page is rendered
iteratively, so nesting depth is not limited by the interpreter's stack.

Edge cases: null or empty html gives an empty text; broken markup is rendered
as far as it can be read, never refused; repeated rows are rendered alike;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

ALIGN_WIDTH = 40

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("script style head title template noscript iframe object audio video canvas datalist".split())
#: SVG and MathML: a slash closes their elements, and these are not shown.
_FOREIGN = frozenset(("svg", "math"))
_UNSEEN_IN = {"svg": frozenset("""title desc metadata defs style script symbol clippath mask pattern marker lineargradient
    radialgradient filter""".split()), "math": frozenset(("annotation", "annotation-xml", "mphantom"))}
_UNSEEN_IN["text"] = _UNSEEN_IN["svg"]
_TOKENS = frozenset(("mi", "mo", "mn", "ms", "mtext"))
#: Start tags that end open SVG and MathML elements.
_BREAKS_OUT = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing
    menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
#: Elements inside SVG and MathML that hold HTML.
_HOLDS_HTML = frozenset(("foreignobject", "title", "desc", "annotation-xml")) | _TOKENS
#: Blocks by the blank lines around them.
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl blockquote pre table figure fieldset form hr".split())
_PLAIN = frozenset("""html body div section article main header footer nav aside address details summary figcaption
    center dialog li dt dd tr caption legend option optgroup select textarea thead tbody tfoot colgroup""".split())
_BLOCKS = _SPACED | _PLAIN
_ENDS_P = _BLOCKS - frozenset("tr thead tbody tfoot colgroup caption option optgroup html body select textarea".split())
_CELLS = frozenset(("td", "th"))
_SECTIONS = frozenset(("thead", "tbody", "tfoot"))
#: A start tag closes these open elements, searched up to these containers.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}), "dd": ({"dt", "dd"}, {"dl", "table"}),
    "td": (_CELLS, {"tr", "table"}), "th": (_CELLS, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    **{s: (_SECTIONS | {"caption", "colgroup"}, {"table"}) for s in _SECTIONS},
    "option": ({"option"}, {"select", "table"}), "optgroup": ({"option", "optgroup"}, {"select", "table"}),
}
_TABLE_PARTS = _CELLS | _SECTIONS | {"tr", "caption", "table"}
#: Hidden elements that an ancestor's end tag does not end: of table parts, of other blocks, of inline elements.
_TABLE_WALL = frozenset(("table", "template", "noscript"))
_BLOCK_WALL = _TABLE_WALL | _CELLS | {"caption", "object"}
_INLINE_WALL = _BLOCK_WALL | _BLOCKS
_BLANK = re.compile(r"[ \t\n\r\f ]+")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!\s*important\s*)?(?:;|$)", re.I)


class Node:
    """``space``: what its content is: "" HTML, "svg" graphics, "text" SVG text, "math" MathML, "token" text of MathML."""

    __slots__ = ("tag", "attrs", "children", "space")

    def __init__(self, tag: str, attrs: dict, space: str = ""):
        self.tag, self.attrs, self.children, self.space = tag, attrs, [], space


class _Builder(HTMLParser):
    """Builds the tree of shown elements; what is inside a hidden element is dropped at once."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.top = Node("html", {})
        self.open = [self.top]
        self.hidden: list[str] = []  # open elements from the outermost hidden one inwards

    def _close_to(self, tags, until) -> None:
        """Closes up to and including the outermost of ``tags`` found before a container of ``until``."""
        at = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in until:
                break
            if self.open[i].tag in tags:
                at = i
        if at is not None:
            del self.open[at:]

    def _ends_hidden(self, tag: str) -> bool:
        """Does this start tag imply the end of the outermost hidden element?"""
        outer, inner = self.hidden[0], set(self.hidden[1:])
        if tag in _CLOSES and outer in _CLOSES[tag][0]:
            return not inner & _CLOSES[tag][1]
        return outer == "p" and tag in _ENDS_P and not inner & {"table", "td", "th", "button", "caption"}

    def _space(self, tag: str) -> str:
        """What the content of an element that starts here is."""
        space = self.open[-1].space
        if tag in _FOREIGN:
            return tag
        if space == "svg" and tag in ("text", "foreignobject"):
            return "text" if tag == "text" else ""
        if space == "text" and tag == "foreignobject" or space == "token":
            return ""
        return "token" if space == "math" and tag in _TOKENS else space

    def _in_foreign(self) -> bool:
        """Is the innermost open element, hidden or not, SVG or MathML?"""
        for tag in reversed(self.hidden):
            if tag in _FOREIGN or tag in _HOLDS_HTML:
                return tag in _FOREIGN
        return self.open[-1].space in ("svg", "text", "math")

    def _breaks_out(self, tag: str, attrs) -> bool:
        """Does this start tag end the open SVG and MathML elements (and hidden ones of theirs)?"""
        html = tag in _BREAKS_OUT or tag == "font" and any(k in ("color", "face", "size") for k, _ in attrs)
        return html and self.open[-1].space in ("svg", "text", "math") and self._in_foreign()

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            if "head" in self.hidden:
                self.hidden.clear()
            return
        if self._breaks_out(tag, attrs):
            self.hidden.clear()
            while self.open[-1].space in ("svg", "text", "math"):
                self.open.pop()
        if self.hidden:
            if (self.hidden == ["head"] and tag in _BLOCKS) or self._ends_hidden(tag):
                self.hidden.clear()  # content ends an unclosed head, a sibling an unclosed item
            else:
                if tag not in _VOID:
                    self.hidden.append(tag)
                return
        attrs = {k: v or "" for k, v in attrs}
        foreign = self.open[-1].space in ("svg", "text", "math")
        if not foreign and tag in _CLOSES:
            self._close_to(*_CLOSES[tag])
        if not foreign and tag in _ENDS_P:
            self._close_to({"p"}, {"table", "td", "th", "button", "caption"})
        if tag in _CELLS and self.open[-1].tag in _SECTIONS | {"table"}:
            self._push(Node("tr", {}))
        unseen = tag in _UNSEEN_IN[self.open[-1].space] if foreign else tag in _UNSEEN or (tag == "dialog" and "open" not in attrs)
        if foreign and (attrs.get("display") == "none" or attrs.get("visibility") in ("hidden", "collapse")):
            unseen = True
        if unseen or "hidden" in attrs or _NOT_SHOWN.search(attrs.get("style", "")) or (tag == "input" and attrs.get("type", "").lower() == "hidden"):
            if tag not in _VOID:
                self.hidden.append(tag)
            return
        node = Node(tag, attrs, self._space(tag))
        if tag in _VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        # a slash closes SVG and MathML elements; on others than these and void ones it has no meaning
        if tag in _FOREIGN or (self._in_foreign() and not self._breaks_out(tag, attrs)):
            return
        self.handle_starttag(tag, attrs)

    def _open_at(self, tag: str) -> int | None:
        """Place of the open element that an end tag ends."""
        wall = {"table"} if tag in _CELLS | _SECTIONS | {"tr", "caption"} else (set() if tag == "table" else {"table", "td", "th"})
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                return i
            if self.open[i].tag in wall:
                return None
        return None

    def _parent_ends(self, tag: str) -> bool:
        """Does this end tag end an open element around the hidden ones, and them with it?"""
        wall = _TABLE_WALL if tag in _TABLE_PARTS else _BLOCK_WALL if tag in _BLOCKS or tag == "dialog" else _INLINE_WALL
        return not wall.intersection(self.hidden) and self._open_at(tag) is not None

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
            return
        if self.hidden:
            if tag in self.hidden:
                at = len(self.hidden) - 1 - self.hidden[::-1].index(tag)
                del self.hidden[at:]
            elif self._parent_ends(tag):
                self.hidden.clear()
                self.handle_endtag(tag)
            elif tag in _CELLS | {"tr", "table", "li", "ul", "ol", "div"} and self.hidden[0] in _CELLS | {"li", "p", "option"}:
                self.hidden.clear()  # the parent of an unclosed hidden item ends
                self.handle_endtag(tag)
            return
        at = self._open_at(tag)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data):
        if self.hidden == ["head"] and data.strip():
            self.hidden.clear()
        if not self.hidden and self.open[-1].space not in ("svg", "math"):
            self.open[-1].children.append(data)


class _Lines:
    """Collects rendered lines: pending blank lines, indentation, collapsed blanks."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # a blank is due before the next inline text
        self.gap = 0  # blank lines due before the next line
        self.indent = 0
        self.marker = ""

    def text(self, data: str) -> None:
        parts = _BLANK.sub(" ", data)
        if not parts.strip(" "):
            self.blank = self.blank or bool(parts)
            return
        if self.line and (self.blank or parts[0] == " "):
            self.line.append(" ")
        self.line.append(parts.strip(" "))
        self.blank = parts[-1] == " "

    def verbatim(self, data: str) -> None:
        first, *rest = data.replace("\r\n", "\n").split("\n")
        self.line.append(first)
        for x in rest:
            self.end_line(keep_empty=True)
            self.line.append(x)

    def end_line(self, keep_empty: bool = False) -> None:
        joined = "".join(self.line)
        self.line, self.blank = [], False
        if not joined and not self.marker and not keep_empty:
            return
        if self.lines and self.gap:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.lines.append((" " * self.indent + self.marker + joined).rstrip(" "))
        if self.marker:
            self.indent += len(self.marker)
            self.marker = ""

    def break_line(self) -> None:
        if self.line:
            self.end_line()
        elif self.lines:
            self.gap = max(self.gap, 1)

    def block(self, lines: list[str]) -> None:
        self.end_line()
        if lines:
            if self.lines and self.gap:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.lines.extend((" " * self.indent + x).rstrip(" ") for x in lines)


def _table_lines(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells (each a list of lines) with columns aligned."""
    widths: list[int] = []
    for row in rows:
        for j, cell in enumerate(row):
            if j == len(widths):
                widths.append(0)
            widths[j] = max([widths[j], *(len(x) for x in cell if len(x) <= ALIGN_WIDTH)])
    out = []
    for row in rows:
        for i in range(max([len(c) for c in row], default=0)):
            parts = [(cell[i] if i < len(cell) else "").ljust(w) for cell, w in zip(row, widths)]
            out.append("  ".join(parts).rstrip(" "))
    return [x for x in out if x]


class _Renderer:
    def __init__(self):
        self.out = [_Lines()]
        self.tables: list[list[list[list[str]]]] = []
        self.lists: list[list] = []  # marker counter (None: bullets) of each open list
        self.margins: list[tuple[int, int]] = []
        self.pre = 0

    def run(self, top: Node) -> str:
        work: list = [(top, True)]
        while work:
            item, entering = work.pop()
            if isinstance(item, str):
                (self.out[-1].verbatim if self.pre else self.out[-1].text)(item)
            elif entering:
                self.enter(item)
                work.append((item, False))
                work.extend((c, True) for c in reversed(item.children))
            else:
                self.leave(item)
        lines = self.out[0]
        lines.end_line()
        return "\n".join(lines.lines)

    def _boundary(self, tag: str) -> None:
        lines = self.out[-1]
        lines.end_line()
        if tag in _SPACED and lines.lines and not (tag in ("ul", "ol", "menu") and len(self.lists) > 1):
            lines.gap = max(lines.gap, 1)

    def enter(self, node: Node) -> None:
        tag, lines = node.tag, self.out[-1]
        if node.space == "token" or (node.space == "text" and tag == "text"):
            lines.text(" ")  # tokens and labels stand apart
        elif tag == "br":
            lines.break_line()
        elif tag == "input":
            if node.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search"):
                lines.text(" " + node.attrs.get("value", "") + " ")
        elif tag in _CELLS:
            if self.tables:
                if not self.tables[-1]:
                    self.tables[-1].append([])
                self.out.append(_Lines())
            else:
                lines.end_line()
        elif tag in _BLOCKS:
            if tag in ("ul", "ol", "menu"):
                start = node.attrs.get("start", "1")
                self.lists.append([int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1] if tag == "ol" else [None])
            self._boundary(tag)
            if tag == "table":
                self.tables.append([])
            elif tag == "tr" and self.tables:
                self.tables[-1].append([])
            elif tag == "pre":
                self.pre += 1
            elif tag in ("li", "dd", "blockquote"):
                self.margins.append((lines.indent, id(lines)))
                if tag == "li":
                    count = self.lists[-1] if self.lists else [None]
                    lines.marker = "- " if count[0] is None else f"{count[0]}. "
                    if count[0] is not None:
                        count[0] += 1
                else:
                    lines.indent += 2

    def leave(self, node: Node) -> None:
        tag = node.tag
        if node.space == "token" or (node.space == "text" and tag == "text"):
            self.out[-1].text(" ")
            return
        if tag in _CELLS and self.tables and len(self.out) > 1:
            cell = self.out.pop()
            cell.end_line()
            self.tables[-1][-1].append(cell.lines)
            return
        if tag not in _BLOCKS:
            return
        lines = self.out[-1]
        if tag == "pre":
            self.pre -= 1
        if tag == "table":
            lines.block(_table_lines(self.tables.pop()))
        lines.end_line()
        if tag in ("li", "dd", "blockquote"):
            lines.marker = ""
            lines.indent = self.margins.pop()[0]
        self._boundary(tag)
        if tag in ("ul", "ol", "menu"):
            self.lists.pop()


def visible_text(html: str | None) -> str:
    """Rendered visible text of one page."""
    if not html:
        return ""
    builder = _Builder()
    try:
        builder.feed(html)
        builder.close()
    except (AssertionError, ValueError):  # a declaration the tokenizer cannot read: what was read so far is shown
        pass
    return _Renderer().run(builder.top)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([visible_text(x.as_py()) for x in batch.column("html")], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), texts], ["page_id", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """pages (page_id, html) -> page_id, text."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "html").mapInArrow(_extract, f"page_id {kind}, text string")


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
