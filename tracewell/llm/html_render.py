"""Visible text of HTML pages, laid out as a browser would order it.

A tree builder reads the tokens of the standard library's tokenizer and applies the rules for implied tags: void elements
have no content, a block closes an open p, items and cells close what they follow, missing end tags close with their
parent. Cells and rows of a table get the rows and groups that have no tag; what stands in a table outside of its cells
goes into a block before it. A renderer walks the tree without recursion. Invisible are head matter, scripts, styles,
templates, values of fields other than a textarea's text and the chosen options of a select (the first one where none is
marked), what frames, media and canvas hold for older browsers, definitions and descriptions inside svg,
annotations inside math, elements with the hidden attribute or aria-hidden, those whose inline style says display:none, and
the own text of those with visibility:hidden, which their descendants inherit until one says visibility:visible; all other
text is kept, navigation and footers too. Inline text has its white space collapsed; pre keeps it. Blocks start
on a new line, paragraphs and headings are set off by an empty line, br breaks the line, hr draws one, list items are
indented by depth, up to MOST_INDENTS levels, under a bullet or their number. A table with cells becomes lines in which each
column is padded to its widest cell of at most PADDED characters (wider ones stand out), cells being parted by ` | `; a cell
that spans columns or rows leaves those after it or below it empty, unless the table would get more than FILLS such places
a cell, when spans are ignored; a cell's own line breaks become spaces. Nested tables are rendered inside, innermost cells
first; those inside MOST_TABLES others are laid out as blocks.

So work and output are linear in the page: a cell of four characters (`<td>`) becomes at most 1 + FILLS places of PADDED + 3.

Defined results: null and empty pages give empty text; broken markup gives the text that the rules leave visible; repeated
rows are rendered each; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INVISIBLE = frozenset("head title script style noscript template iframe canvas audio video datalist input".split())
#: Invisible inside svg or math.
DEFINITIONS = frozenset("desc metadata defs symbol clippath mask pattern marker annotation annotation-xml".split())
#: Elements of svg and math that stand apart from each other.
PLACED = frozenset("text mtr mlabeledtr mtd".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
BLOCK = SPACED | frozenset("address article aside body caption center dd details dialog div dt fieldset figcaption footer form header hgroup html legend li main menu nav section summary tr thead tbody tfoot td th".split()) | PLACED
#: A start tag of the key closes open elements of the first set, if they're inside none of the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
CLOSES_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body"} - PLACED | {"hr"}
GROUPS = frozenset({"tbody", "thead", "tfoot"})
PARTS = GROUPS | {"caption", "colgroup", "col", "tr", "td", "th"}
#: Elements of a table that hold no text of their own.
FRAME = GROUPS | {"table", "colgroup", "tr"}
#: Where the search for the table that an element stands in ends.
CONTENTS = frozenset({"table", "caption", "td", "th", "template", "noscript"})
HEAD_ONLY = frozenset("title meta link base script style template noscript head html".split())
HIDDEN_STYLE = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?<![-\w])visibility\s*:\s*([a-z]+)", re.I)
COLLAPSIBLE = frozenset({"tr", "tbody", "thead", "tfoot"})
PADDED = 40
FILLS = 3
MOST_INDENTS = 16
MOST_TABLES = 32
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    """scope: the innermost element of CONTENTS that it stands in or is, else the root; p: the p that a block inside it closes; visibility: as inherited."""

    __slots__ = ("attrs", "children", "drawn", "opened", "p", "parent", "scope", "tag", "visibility")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        own = parent is None or tag in CONTENTS
        self.scope = self if own else parent.scope
        self.opened: dict[str, int] | None = {} if own else None  # of a scope: its open elements by tag
        self.p = self if tag == "p" else None if own or tag == "button" else parent.p
        self.drawn = parent is not None and (parent.tag in ("svg", "math") or parent.drawn)  # inside svg or math
        said = [v.lower() for v in VISIBILITY.findall(attrs.get("style") or "")][-1:]
        self.visibility = said[0] if said and said[0] in ("visible", "hidden", "collapse") else "visible" if said == ["initial"] or parent is None else parent.visibility

    def seen(self) -> bool:
        """Whether its own text is drawn."""
        return self.visibility == "visible"

    def hidden(self) -> bool:
        a = self.attrs
        """Whether nothing in it is drawn."""
        return self.tag in INVISIBLE or (self.tag in DEFINITIONS and self.drawn) or (self.tag in COLLAPSIBLE and self.visibility == "collapse") or "hidden" in a or (a.get("aria-hidden") or "").lower() == "true" or bool(HIDDEN_STYLE.search(a.get("style") or ""))


class Builder(HTMLParser):
    """The tree of a page. A node's parent is the element that was open around it; its place in the tree may be before a table.

    Open elements are counted by scope, so that a search for one that isn't there costs nothing at any depth.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)
        self.open: dict[str, int] = {}  # by tag, in all scopes
        self.before: dict[Node, Node] = {}  # by table, the block before it for what stands outside of its cells

    def close(self) -> Node:
        super().close()
        return self.root

    def _to(self, node: Node) -> None:
        """Closes what is open inside node."""
        while self.at is not node:
            # a scope's own element counts outside of it
            (self.at.parent if self.at.opened is not None else self.at).scope.opened[self.at.tag] -= 1
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def _push(self, node: Node) -> None:
        opened = (node.parent if node.opened is not None else node).scope.opened
        opened[node.tag] = opened.get(node.tag, 0) + 1
        self.open[node.tag] = self.open.get(node.tag, 0) + 1
        self.at = node

    def _close_open(self, tags: set[str] | frozenset[str], within: set[str] | frozenset[str]) -> None:
        """Closes the outermost open element of tags that no element of within has inside itself."""
        if not any(map(self.open.get, tags)):
            return
        node, last, scope, left = self.at, None, None, 0
        while node is not self.root and node.tag not in within:
            if node.scope is not scope:
                scope = node.scope
                left = sum(scope.opened.get(t, 0) for t in tags)
            if node.tag in tags:
                last = node
                left -= node is not scope
            if not left and node is not scope:  # nothing more up to the scope's own element
                node = scope
                continue
            node = node.parent
        if last is not None:
            self._to(last.parent)

    def _enter(self, tag: str) -> None:
        """Before a part of a table: leaves what it ends and opens the group and row around it that have no tag."""
        table = self.at.scope
        if table.tag in ("caption", "td", "th") and (outer := table.parent.scope).tag == "table":
            self._to(table.parent)
            table = outer
        if table.tag != "table":  # a part without a table
            tags, within = IMPLIED.get(tag, (set(), set()))
            return self._close_open(tags, within | {"template", "noscript"})
        inside = GROUPS | {"tr"} if tag in ("td", "th") else GROUPS if tag == "tr" else ()
        up = self.at
        while up is not table and up.tag not in inside:
            up = up.parent
        self._to(up)
        if self.at is table and tag in ("td", "th", "tr"):
            self._open(Node("tbody", {}, table))
        if self.at.tag in GROUPS and tag in ("td", "th"):
            self._open(Node("tr", {}, self.at))
        if block := self.before.get(table):
            block.children.append(" ")
        return None

    def _open(self, node: Node) -> None:
        self.at.children.append(node)
        self._push(node)

    def _children(self) -> list[Node | str]:
        """Where visible content goes: the open element's children, or the block before the table that it stands in."""
        if self.at.tag in FRAME and (table := self.at.scope).tag == "table":
            if table not in self.before:
                self.before[table] = Node("div", {}, table.parent)
                table.parent.children.insert(-1, self.before[table])  # an open table is its parent's last child
            return self.before[table].children
        return self.at.children

    def handle_starttag(self, tag, attrs):
        if tag in PARTS:
            self._enter(tag)
        elif tag == "table" and (table := self.at.scope).tag == "table":
            self._to(table.parent)  # only cells and captions hold tables
        elif tag == "form" and self.at.tag in FRAME and self.at.scope.tag == "table":
            return  # its fields are in cells
        elif tag in IMPLIED:
            self._close_open(*IMPLIED[tag])
        elif tag not in HEAD_ONLY:
            self._close_open({"head"}, set())
        if tag in CLOSES_P and self.at.p is not None:
            self._to(self.at.p.parent)
        node = Node(tag, dict(attrs), self.at)
        (self.at.children if self.at.tag not in FRAME or tag in PARTS or node.hidden() else self._children()).append(node)
        if tag not in VOID:
            self._push(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.at.tag == tag and tag not in VOID and (self.at.drawn or tag in ("svg", "math")):  # elsewhere the slash means nothing
            self._to(self.at.parent)

    def handle_endtag(self, tag):
        if tag == "br":
            return self.handle_starttag("br", [])
        node = self.at if self.open.get(tag) else self.root
        while node is not self.root and node.tag != tag:
            if not node.scope.opened.get(tag) and node is not node.scope:
                node = node.scope
                continue
            if node.tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "body", "html", "template", "noscript"):
                return None  # a stray end tag doesn't leave its cell
            if node.tag == "table" and tag in PARTS:
                return None  # nor its table
            node = node.parent
        if node is not self.root:
            self._to(node.parent)
        return None

    def handle_data(self, data):
        if data.strip():
            if self.at.tag == "head":
                self._to(self.at.parent)
            self._children().append(data)
        elif self.at.tag in FRAME:  # white space in a table only parts what stands before it
            self.before.get(self.at.scope, self.at).children.append(data)
        else:
            self.at.children.append(data)


class Lines:
    """Text that is laid out line by line."""

    def __init__(self):
        self.parts: list[str] = []  # finished lines
        self.line: list[str] = []
        self.gap, self.space, self.empty, self.prefix = 0, False, True, ""

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *rest = data.split("\n")
            self._add(first)
            for part in rest:
                self.end_line(True)
                self._add(part)
            return
        data = SPACE.sub(" ", data)
        if data[:1] == " ":
            self.space = True
        word = data.strip(" ")
        if word:
            self._add((" " if self.space and not self.empty else "") + word)
            self.space = data[-1] == " "

    def _add(self, data: str) -> None:
        if data:
            if self.empty and self.gap and self.parts:
                self.parts.extend([""] * (self.gap - 1))
            if self.empty:
                self.line, self.prefix = [self.prefix], " " * len(self.prefix)
            self.line.append(data)
            self.empty, self.gap = False, 0

    def end_line(self, forced: bool = False) -> None:
        if not self.empty:
            self.parts.append("".join(self.line).rstrip())
        elif forced and self.parts:
            self.parts.append("")
        self.line, self.empty, self.space = [], True, False

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = max(self.gap, 2 if spaced else 1)

    def __str__(self) -> str:
        self.end_line()
        return "\n".join(self.parts).strip("\n")


def table_rows(table: Node) -> list[list[Node]]:
    """The visible cells by row, without those of nested tables."""
    rows, todo = [], [table]
    while todo:
        node = todo.pop()
        if node.tag == "tr":
            if cells := [c for c in node.children if isinstance(c, Node) and c.tag in ("td", "th") and not c.hidden()]:
                rows.append(cells)
        elif node is table or node.tag in ("thead", "tbody", "tfoot"):
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.hidden())
    return rows


def span(cell: Node, name: str, most: int) -> int:
    value = (cell.attrs.get(name) or "1").strip()
    return max(1, min(most, int(value))) if re.fullmatch(r"\d{1,9}", value) else 1


def grid(rows: list[list[Node]], texts: dict[Node, str]) -> list[list[str]]:
    """The texts of the cells by row and column; spans go no further than the longest row's number of cells and the last row."""
    widest = max(map(len, rows))
    left = FILLS * sum(map(len, rows))  # places that spans may take yet
    held: dict[int, int] = {}  # by column, the rows that a cell from above still takes
    found = []
    for i, row in enumerate(rows):
        line: list[str] = []
        fresh: dict[int, int] = {}
        left -= len(held)
        for cell in row:
            while held.get(len(line), 0):
                line.append("")
            tall, wide = span(cell, "rowspan", len(rows) - i), span(cell, "colspan", widest)
            left -= wide - 1
            if left < 0:
                return [[texts[c] for c in r] for r in rows]
            for k in range(wide):
                fresh[len(line)] = tall
                line.append("" if k else texts[cell])
        held = {c: n - 1 for c, n in (held | fresh).items() if n > 1}
        found.append(line)
    return found


def aligned(rows: list[list[str]]) -> list[str]:
    widths = [0] * max(map(len, rows))
    for row in rows:
        for k, cell in enumerate(row):
            widths[k] = max(widths[k], min(len(cell), PADDED))
    return [" | ".join(cell.ljust(w) for cell, w in zip(row, widths, strict=False)).rstrip() for row in rows]


def shown(select: Node) -> list[Node]:
    """The options that a select shows."""
    options, todo = [], [select]
    while todo:
        node = todo.pop()
        if node.tag == "option":
            options.append(node)
        elif node is select or not node.hidden():
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    options = [o for o in options if not o.hidden()]
    if "multiple" in select.attrs or span(select, "size", 1000) > 1:
        return options
    return [o for o in options if "selected" in o.attrs][-1:] or options[:1]


def content(node: Node) -> list[Node | str]:
    """Its children, without its own text where that isn't drawn."""
    return node.children if node.seen() else [c for c in node.children if isinstance(c, Node)]


def laid_out(root: Node, texts: dict[Node, str]) -> str:
    """A subtree's text; texts has those of the cells and captions of the tables inside it. The walk keeps its own stack: leaving a node is an entry with `done`."""
    out, todo, lists, pre = Lines(), [(root, False)], [], 0
    while todo:
        node, done = todo.pop()
        if isinstance(node, str):
            out.text(node, pre > 0)
            continue
        tag = node.tag
        if done:
            if tag in ("pre", "textarea"):
                pre -= 1
            if tag in ("ul", "ol", "menu"):
                lists.pop()
            if tag == "li":
                out.end_line()
                out.prefix = ""
            if tag in BLOCK:
                out.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            continue
        if node is not root and node.hidden():
            continue
        if tag == "br":
            out.end_line(True)
        elif tag == "hr":
            out.block(True)
            out.text("---" if node.seen() else "", False)
            out.block(True)
        elif tag == "img":
            if node.seen() and (alt := (node.attrs.get("alt") or "").strip()):
                out.text(alt, False)
        elif tag == "select":
            for option in reversed(shown(node)):
                todo.extend((c, False) for c in (" ", *reversed(content(option)), " "))
        elif tag == "table" and node is not root and (rows := table_rows(node)) and rows[0][0] in texts:
            out.block(True)
            for caption in (c for c in node.children if isinstance(c, Node) and c.tag == "caption" and not c.hidden()):
                out.text(texts[caption], False)
                out.end_line()
            rows = [r for r in rows if any(c.seen() or texts[c] for c in r)]
            for line in aligned(grid(rows, texts)) if rows else []:
                if line:
                    out.text(line, True)
                out.end_line()
            out.block(True)
        else:
            if tag in BLOCK:
                out.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag in BLOCK or tag == "textarea":
                todo.append((node, True))
            if tag in ("pre", "textarea"):
                pre += 1
            if tag in ("ul", "ol", "menu"):
                start = node.attrs.get("start") or "1"
                lists.append(int(start) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", start) else 1 if tag == "ol" else None)
            if tag == "li":
                number = lists[-1] if lists else None
                out.prefix = "  " * min(MOST_INDENTS, max(0, len(lists) - 1)) + ("- " if number is None else f"{number}. ")
                if not node.seen():
                    out.prefix = " " * len(out.prefix)
                if number is not None:
                    lists[-1] += 1
            todo.extend((c, False) for c in reversed(content(node)))
    return str(out)


def rendered(root: Node) -> str:
    """The text of a page, after those of the cells and captions of its tables, inner ones before outer ones."""
    parts: list[Node] = []
    todo: list[tuple[Node, int]] = [(root, 0)]  # with the number of tables around it
    while todo:
        node, depth = todo.pop()
        if node is root or not node.hidden():
            if node.tag == "table" and depth < MOST_TABLES and (rows := table_rows(node)):
                parts += [c for row in rows for c in row]
                parts += [c for c in node.children if isinstance(c, Node) and c.tag == "caption" and not c.hidden()]
                depth += 1
            todo.extend((c, depth) for c in reversed(node.children) if isinstance(c, Node))
    texts: dict[Node, str] = {}
    for part in reversed(parts):  # what is inside a part comes after it in parts
        texts[part] = SPACE.sub(" ", laid_out(part, texts))
    return laid_out(root, texts)


def render(html: str | None) -> str:
    if not html:
        return ""
    builder = Builder()
    builder.feed(html)
    return rendered(builder.close())


def render_pages(pages: DataFrame) -> DataFrame:
    """page_id, the visible text and its number of lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(h) for h in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], ["page_id", "text", "n_lines"])

    rows = pages.select("page_id", "html")
    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, text string, n_lines long")
