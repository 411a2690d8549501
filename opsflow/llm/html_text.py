"""Visible text of HTML pages, laid out as a reader sees it.

A page is cut into tags and text, built into a tree (with the end tags that HTML lets
authors leave out), and rendered: hidden parts go, blocks stand on lines of their own,
paragraphs and headings are set off by blank lines, list items get bullets or numbers and
are indented by depth, table cells are aligned in columns, preformatted text keeps its
white space, and all other white space collapses. Text areas are blocks that keep their
white space; of svg the text elements are shown, a line each, and of math all but annotations.

``display: none`` and ``hidden`` cut off all that is inside; visibility is inherited, so an
element can show itself inside a hidden one. Only attributes count: style sheets are not
applied, and a closed ``details`` is shown in full.

Left out: select elements with their options, text that svg defines for use elsewhere
(defs, symbol), and what is no text of the page: labels of input buttons, ``alt`` texts.

Defined cases: a null page gives null, an empty one an empty text; markup that is cut off
or badly nested is closed at the end; tags are never emitted; pages of any length and
depth are walked without recursion, in time and output that grow with the page. For that,
lists indent their lines by at most ``MAX_INDENT`` blanks, and tables inside more than
``TABLE_DEPTH`` others are set as blocks, cell by cell. No text is lost by either.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# A quote opens a quoted value only after "="; anywhere else it is a character of a name or of an unquoted value.
VALUE = r"\"[^\"]*+\"|'[^']*+'|[^ \t\n\r\f>]++"
TOKEN = re.compile(
    r"<!--(?:-?>|(?s:.*?)(?:--!?>|\Z))|<[!?][^>]*+>?|</([a-zA-Z][^\s/>]*+)[^>]*+>?"
    r"|<([a-zA-Z][^\s/>]*+)((?:[ \t\n\r\f/]++|[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:" + VALUE + r")?+)?+)*+)>?"
)
ATTRIBUTE = re.compile(r"([^ \t\n\r\f/>][^ \t\n\r\f/>=]*+)(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(" + VALUE + r"))?+")
SPACES = re.compile(r"[ \t\n\r\f]+")
HIDING_STYLE = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(\w+)", re.I)

MAX_INDENT = 80
TABLE_DEPTH = 8

# Element names by the role that HTML gives them.
VOID = set("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
OF_HEAD = set("base basefont bgsound link meta title style script template noscript noframes".split())
HIDDEN = set("head script style template noscript title iframe object video audio canvas noembed noframes datalist select".split())
# Inside svg and math, which follow rules of their own.
HIDDEN_FOREIGN = set("title desc metadata defs symbol clippath mask pattern marker annotation annotation-xml".split())
HOLDS_HTML = set("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
FOREIGN_BLOCKS = set("text foreignobject mtr".split())
ENDS_FOREIGN = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s"
    " small span strong strike sub sup table tt u ul var".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset".split())
BLOCKS = SPACED | set(
    "html body address article aside center dd details dialog dir div dt figcaption footer form header hgroup legend li main menu nav"
    " option section summary textarea caption tbody thead tfoot tr td th".split())
ENDS_P = SPACED | set(
    "address article aside center details dialog dir div dd dt figcaption footer form header hgroup li main menu nav section summary".split())
LISTS = {"ul", "ol", "menu", "dir"}
# An opening tag closes the named elements, if one is open above the nearest of the limits.
CLOSES = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
#: An end tag does not close elements outside the nearest of these, unless it is of a table's part or of the page.
SCOPES = {"td", "th", "table", "caption", "html"}
TABLE_PARTS = {"table", "tr", "tbody", "thead", "tfoot", "html", "body"}


class Node:
    """``shown``: displayed at all; ``visible``: its own text can be seen.

    ``foreign``: "math", "svg" (where text is not drawn), "text" (a text element of svg) or empty.
    """

    __slots__ = ("tag", "shown", "visible", "attributes", "children", "foreign")

    def __init__(self, tag: str, shown: bool, visible: bool, attributes: dict[str, str], foreign: str = ""):
        self.tag, self.shown, self.visible, self.attributes, self.children, self.foreign = tag, shown, visible, attributes, [], foreign


class _Open:
    """The open elements, outermost first, and the places of every tag among them, so that none is searched for."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def pop(self) -> None:
        self.places[self.nodes.pop().tag].pop()

    def innermost(self, tags) -> int:
        """Place of the innermost element with one of ``tags``; 0, the root's, if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close_from(self, place: int) -> None:
        while len(self.nodes) > place:
            self.pop()

    def close_within(self, names: set[str], limits: set[str]) -> None:
        """Closes up to the outermost of ``names`` above the nearest of ``limits``."""
        limit, cut = self.innermost(limits), len(self.nodes)
        for name in names:
            places = self.places.get(name, ())
            first = bisect_right(places, limit)
            if first < len(places):
                cut = min(cut, places[first])
        self.close_from(cut)

    def close(self, tag: str) -> None:
        """An end tag."""
        place = self.innermost((tag,))
        if place and (tag in TABLE_PARTS or place >= self.innermost(SCOPES)):
            self.close_from(place)


def parse(page: str) -> Node:
    """The page as a tree; a child is a node or a piece of text."""
    root = Node("html", True, True, {})
    stack, at, end = _Open(root), 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        start = found.start() if found else end
        if start > at:
            _add_text(stack, page[at:start])
        if not found:
            break
        at = found.end()
        closing, opening, rest = found.group(1), found.group(2), found.group(3)
        if closing:
            stack.close(closing.lower())
        elif opening:
            tag = opening.lower()
            node = _open(stack, tag, rest)
            if tag in VOID or node.foreign and node.tag == tag and rest.endswith("/"):
                stack.pop()
            elif tag in RAW and not node.foreign:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
                if node.shown and node.visible:
                    body = page[at : stop.start() if stop else end]
                    node.children.append(html.unescape(body).removeprefix("\n") if tag == "textarea" else body)
                at = stop.end() if stop else end
                stack.pop()
        elif stack.top.foreign and page.startswith("<![CDATA[", start):
            stop = page.find("]]>", start)
            _add_text(stack, html.escape(page[start + 9 : stop if stop >= 0 else end]))
            at = stop + 3 if stop >= 0 else end
    return root


def _add_text(stack: _Open, text: str) -> None:
    if stack.top.tag in ("table", "tbody", "thead", "tfoot", "tr") and not text.strip():
        return
    if stack.top.foreign == "svg" and stack.top.tag not in HOLDS_HTML:
        return
    if stack.top.tag == "head" and text.strip():
        stack.pop()
    if stack.top.visible:
        stack.top.children.append(html.unescape(text) if "&" in text else text)


def _open(stack: _Open, tag: str, rest: str) -> Node:
    while tag in ENDS_FOREIGN and stack.top.foreign and stack.top.tag not in HOLDS_HTML:
        stack.pop()
    if tag in ENDS_P:
        stack.close_within({"p"}, SCOPES | {"button"})
    if stack.top.tag == "head" and tag not in OF_HEAD:
        stack.pop()
    if tag in CLOSES:
        stack.close_within(*CLOSES[tag])
    attributes = {}
    if "=" in rest or "hidden" in rest.lower() or tag == "dialog":
        for name, value in ATTRIBUTE.findall(rest):
            attributes.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in "\"'" and value else value))
    foreign = "" if stack.top.tag in HOLDS_HTML else stack.top.foreign
    if tag in ("svg", "math") or tag == "text" and foreign == "svg":
        foreign = tag
    if len(stack.nodes) > 1 and (tag == "html" or tag == "body" and stack.places.get("body")):
        return stack.top
    node = Node(tag, _shown(tag, attributes, foreign), _visible(stack.top.visible, attributes, foreign), attributes, foreign)
    stack.top.children.append(node)
    stack.push(node)
    return node


def _shown(tag: str, attributes: dict[str, str], foreign: str) -> bool:
    if foreign and (tag in HIDDEN_FOREIGN or attributes.get("display") == "none"):
        return False
    return not (tag in HIDDEN or "hidden" in attributes or tag == "dialog" and "open" not in attributes
                or "style" in attributes and HIDING_STYLE.search(attributes["style"]))


def _visible(inherited: bool, attributes: dict[str, str], foreign: str) -> bool:
    """The last declaration counts; what is no value of its own is inherited."""
    said = VISIBILITY.findall(attributes.get("style", "")) or ([attributes["visibility"]] if foreign and "visibility" in attributes else [])
    value = said[-1].lower() if said else ""
    return value in ("visible", "initial") or inherited and value not in ("hidden", "collapse")


class _Lines:
    """Lines of one flow: collapses white space, keeps at most one blank line between blocks.

    A line is (indent, text). Items of lists go on in the flow that they stand in: their
    marks wait for the item's first line, and later ones are indented by them.
    """

    def __init__(self):
        self.lines: list[tuple[int, str]] = []
        self.now: list[str] = []
        self.space = False
        self.blank = False  # a blank line is due before the next one, if the flow or item has begun
        self.begun = False  # there is a line in the flow, or in the innermost item
        self.due = False  # a blank line is due before the item
        self.indent = 0
        self.marks: list[str] = []  # of items without a line so far, the outermost at indent ``marks_at``
        self.marks_at = 0

    def text(self, piece: str, keep: bool) -> None:
        if keep:
            first, *others = piece.split("\n")
            self._put(first)
            for line in others:
                self.end(force=True)
                self._put(line)
            return
        words = SPACES.split(piece)
        if not words[0]:
            self.space = True
        body = " ".join(w for w in words if w)
        if body:
            self._put((" " if self.space and self.now else "") + body)
            self.space = not words[-1]

    def _put(self, body: str) -> None:
        if body:
            self.now.append(body)

    def end(self, force: bool = False, further: int = 0) -> None:
        if self.now or force:
            if self.due or self.blank and self.begun:
                self.lines.append((0, ""))
            text = "".join([*self.marks, *self.now]).rstrip()
            self.lines.append((self.marks_at if self.marks else self.indent + further, text))
            self.blank = self.due = False
            self.begun = True
            self.marks = []
        self.now, self.space = [], False

    def gap(self) -> None:
        self.end()
        self.blank = True

    def block(self, lines: list[tuple[int, str]]) -> None:
        self.end()
        for further, line in lines:
            self.now = [line]
            self.end(True, further)

    def enter_item(self, mark: str) -> tuple[bool, bool, int, int]:
        self.end()
        self.due = self.due or self.blank and self.begun
        before = self.due, self.begun, self.indent, len(self.lines)
        if not self.marks:
            self.marks_at = self.indent
        self.marks.append(mark)
        self.indent += len(mark)
        self.blank = self.begun = False
        return before

    def leave_item(self, before: tuple[bool, bool, int, int], marked: bool) -> None:
        due, begun, indent, start = before
        self.end()
        if self.begun:
            while len(self.lines) > start and not self.lines[-1][1]:
                self.lines.pop()
            if len(self.lines) == start:
                self.lines += [(0, "")] * (1 + due)
        elif marked:
            self.end(force=True)
        else:
            self.marks.pop()
            self.begun = begun
        self.blank, self.indent = False, indent

    def done(self) -> list[tuple[int, str]]:
        self.end()
        while self.lines and not self.lines[-1][1]:
            self.lines.pop()
        return self.lines


def _strings(lines: list[tuple[int, str]]) -> list[str]:
    return [" " * min(indent, MAX_INDENT) + text if text else "" for indent, text in lines]


class _Frame:
    """An element that is being rendered; ``extra`` is what its children need to know of it."""

    __slots__ = ("node", "place", "own", "pre", "extra", "listed", "tables")

    def __init__(self, node: Node, own: _Lines, pre: bool, extra: dict | None, listed: bool, tables: int):
        self.node, self.place, self.own, self.pre, self.extra, self.listed, self.tables = node, 0, own, pre, extra, listed, tables


def render(root: Node) -> str:
    """The tree as text."""
    flow = _Lines()
    frames = [_Frame(root, flow, False, None, False, 0)]
    while frames:
        frame = frames[-1]
        if frame.place == len(frame.node.children):
            frames.pop()
            _leave(frame, frames)
            continue
        child = frame.node.children[frame.place]
        frame.place += 1
        if isinstance(child, str):
            frame.own.text(child, frame.pre)
        elif child.shown:
            _enter(child, frame, frames)
    return "\n".join(_strings(flow.done()))


def _enter(child: Node, frame: _Frame, frames: list[_Frame]) -> None:
    tag, own, pre = child.tag, frame.own, frame.pre
    extra = frame.extra or {}
    listed, tables = frame.listed, frame.tables
    if tag == "br":
        own.end(force=child.visible)
        return
    if tag == "hr":
        own.gap()
        return
    if tag == "table" and tables < TABLE_DEPTH:
        own.gap()
        own, pre, inner, tables = _Lines(), False, {"grid": []}, tables + 1
    elif tag == "tr" and "grid" in extra:
        extra["grid"].append([])
        inner = extra
    elif tag in ("td", "th") and "grid" in extra:
        if not extra["grid"]:
            extra["grid"].append([])
        own, inner = _Lines(), {"cell": extra}
    elif tag in ("tbody", "thead", "tfoot") and "grid" in extra:
        inner = extra
    elif tag in ("li", "dd"):
        own.end()
        number = extra.get("next") if tag == "li" else None
        if number is not None:
            extra["next"] = number + 1
        mark = "  " if tag == "dd" else "- " if number is None else f"{number}. "
        inner, listed = {"before": own.enter_item(mark if child.visible else " " * len(mark))}, True
    elif tag in LISTS:
        own.end() if listed else own.gap()
        start = child.attributes.get("start", "1")
        first = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
        inner = {"next": first if tag == "ol" else None, "nested": listed}
    else:
        if tag in SPACED:
            own.gap()
        elif tag in BLOCKS or child.foreign and (
                tag in FOREIGN_BLOCKS or tag == "tspan" and ("x" in child.attributes or "y" in child.attributes)):
            own.end()
        elif child.foreign and frame.node.tag in ("mfrac", "mtr"):
            own.space = True  # above or beside the last one
        pre, inner = pre or tag in ("pre", "textarea"), frame.extra if tag in ("form", "colgroup") else None
    frames.append(_Frame(child, own, pre, inner, listed, tables))


def _leave(frame: _Frame, frames: list[_Frame]) -> None:
    if not frames:
        return
    node, own, extra = frame.node, frame.own, frame.extra or {}
    outer, tag = frames[-1].own, node.tag
    if "before" in extra and tag in ("li", "dd"):
        own.leave_item(extra["before"], node.visible)
    elif "cell" in extra and tag in ("td", "th"):
        spans = [node.attributes.get(k, "1") for k in ("colspan", "rowspan")]
        width, height = (min(1000, int(s)) if re.fullmatch(r"\d{1,9}", s) and int(s) else 1 for s in spans)
        extra["cell"]["grid"][-1].append((_strings(own.done()), width, height))
    elif "grid" in extra and tag == "table":
        # Text of the table outside its cells (captions, misplaced text) comes before it.
        outer.block(own.done())
        outer.block([(0, line) for line in aligned(extra["grid"])])
        outer.gap()
    elif tag in LISTS:
        outer.end() if extra.get("nested") else outer.gap()
    elif tag in SPACED:
        own.gap()
    elif (tag in BLOCKS or node.foreign and tag in FOREIGN_BLOCKS) and "grid" not in extra:
        own.end()


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of (lines, columns, rows spanned) as lines with every column padded to its widest cell."""
    placed, busy = [], {}  # busy: column -> rows it is still taken for, from a cell above
    for row in rows:
        column, cells, taken = 0, [], {}
        for lines, width, height in row:
            while busy.get(column, 0) > 0:
                column += 1
            cells.append((column, width, lines))
            if height > 1:
                taken.update({c: height - 1 for c in range(column, column + width)})
            column += width
        busy = {c: n - 1 for c, n in busy.items() if n > 1} | taken
        placed.append(cells)
    widths: dict[int, int] = {}
    for cells in placed:
        for column, width, lines in cells:
            if width == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
    starts, at = {}, 0
    for column in range(max((c + w for cells in placed for c, w, _ in cells), default=0)):
        starts[column] = at
        at += widths.get(column, 0) + 2 * (column in widths)
    out = []
    for cells in placed:
        for i in range(max((len(lines) for _, _, lines in cells), default=0)):
            line = ""
            for column, _, lines in cells:
                if i < len(lines) and lines[i]:
                    line = line.ljust(starts[column])
                    line += ("  " if line and not line.endswith("  ") else "") + lines[i]
            out.append(line.rstrip())
    return out


def visible_text(page: str | None) -> str | None:
    return None if page is None else render(parse(page))


def extract(page: Column) -> Column:
    """The visible text of a column of pages."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([visible_text(p) for p in pages.tolist()], dtype=object)

    return extracted(page)
