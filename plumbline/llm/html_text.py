"""Layout-aware text of web pages.

A tree builder makes up for tags that HTML lets authors leave out, visibility rules take away what a browser would not show,
and a renderer writes the rest as plain text: blocks on lines of their own, a blank line where a browser leaves a margin, list
items behind their marks, and the cells of a table under each other.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.batches import portions

# Fixed values of the language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RAW_WITH_ENTITIES = frozenset("textarea title".split())
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "li main menu nav ol p pre search section summary table ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an open element is closed by, and beyond which elements it is not looked for.
IMPLIED_ENDS = {
    "li": (("li",), frozenset(("ul", "ol", "menu", "dir", "table"))),
    "dt": (("dt", "dd"), frozenset(("dl", "table"))),
    "dd": (("dt", "dd"), frozenset(("dl", "table"))),
    "option": (("option",), frozenset(("select", "datalist"))),
    "optgroup": (("option", "optgroup"), frozenset(("select",))),
    "td": (("td", "th"), frozenset(("table",))),
    "th": (("td", "th"), frozenset(("table",))),
    "tr": (("td", "th", "tr", "caption", "colgroup"), frozenset(("table",))),
    "thead": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"), frozenset(("table",))),
    "tbody": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"), frozenset(("table",))),
    "tfoot": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"), frozenset(("table",))),
}
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())
IN_TABLE = frozenset("caption colgroup col thead tbody tfoot tr td th style script template form input".split())
SCOPES = frozenset("table td th caption button template html".split())
UNSEEN = frozenset("head script style template title datalist audio video canvas object noembed noframes iframe param rp".split())
#: In drawings text elements show, but for these; in formulas all but annotations. HTML tags of BREAKS_OUT end either.
UNSEEN_IN = {
    "svg": frozenset("title desc metadata defs symbol clippath mask pattern marker script style".split()),
    "math": frozenset(("annotation", "annotation-xml")),
}
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed foreignobject h1 h2 h3 h4 h5 h6 hr i img li listing menu nobr ol p pre ruby s small span "
    "strong strike sub sup table tt u ul var".split()
)
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl blockquote pre figure table fieldset hr xmp".split())
PREFORMATTED = frozenset("pre textarea plaintext xmp".split())
BLOCK = CLOSES_P | frozenset("body html li tr legend optgroup option caption thead tbody tfoot textarea".split())
LISTS = frozenset("ul ol menu dir".split())

SPACE = " \t\n\f\r"
#: Columns wider than this are not padded.
WIDEST = 80
#: Spans that the language allows at most.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534

NAME = re.compile(r"[a-zA-Z][^ \t\n\f\r/>]*")
ATTRIBUTE = re.compile(r"[ \t\n\f\r/]*([^ \t\n\f\r/>][^ \t\n\f\r/>=]*)(?:[ \t\n\f\r]*=[ \t\n\f\r]*(\"[^\"]*\"|'[^']*'|[^ \t\n\f\r>]*))?")
TAG_END = re.compile(r"[^>]*>")
COMMENT_END = re.compile(r"--!?>")
NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|initial|hidden|collapse)\b", re.IGNORECASE)
ENDS = {tag: re.compile(rf"</{tag}(?=[ \t\n\f\r/>])", re.IGNORECASE) for tag in RAW | RAW_WITH_ENTITIES}


class Node:
    __slots__ = ("tag", "attributes", "children", "parent")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []


class Tree:
    """Builds the tree of a page: `start`, `end` and `text` in the order of the source."""

    def __init__(self):
        self.root = Node("html", {}, None)
        self.open = [self.root]
        self.count: Counter[str] = Counter(("html",))

    def push(self, tag: str, attributes: dict[str, str]) -> Node:
        node = Node(tag, attributes, self.open[-1])
        self.open[-1].children.append(node)
        self.open.append(node)
        self.count[tag] += 1
        return node

    def pop_to(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.count[node.tag] -= 1
        del self.open[depth:]

    def find(self, tags, stop) -> int:
        """Depth of the innermost open element of these tags, unless one of stop is met before; else 0."""
        if not any(self.count[t] for t in tags):
            return 0
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.open[depth].tag
            if tag in tags:
                return depth
            if tag in stop:
                return 0
        return 0

    def outermost(self, tags, stop) -> int:
        """As find, but the outermost before stop."""
        if not any(self.count[t] for t in tags):
            return 0
        found = 0
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.open[depth].tag
            if tag in tags:
                found = depth
            elif tag in stop:
                break
        return found

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body"):
            if depth := self.find(("head",), ()):
                self.pop_to(depth)
            self.root.attributes = {**attributes, **self.root.attributes}
            return
        if tag == "head":
            if not self.count["head"] and not self.root.children:
                self.push(tag, attributes)
            return
        if self.count["head"] and tag not in HEAD_ONLY and (depth := self.find(("head",), ())):
            self.pop_to(depth)
        if tag in CLOSES_P and (depth := self.find(("p",), SCOPES)):
            self.pop_to(depth)
        if tag in IMPLIED_ENDS:
            ended, stop = IMPLIED_ENDS[tag]
            find = self.outermost if tag in ("tr", "thead", "tbody", "tfoot", "optgroup") else self.find
            if depth := find(ended, stop):
                self.pop_to(depth)
        elif tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop_to(len(self.open) - 1)
        here = self.open[-1].tag
        if tag in ("td", "th") and here in ("table", "thead", "tbody", "tfoot"):
            self.push("tr", {})
        elif here in TABLE_PARTS and tag not in IN_TABLE:
            self.foster(Node(tag, attributes, None), tag not in VOID)
            return
        if tag in VOID:
            self.open[-1].children.append(Node(tag, attributes, self.open[-1]))
        else:
            self.push(tag, attributes)

    def foster(self, child: Node | str, stays_open: bool = False) -> None:
        """Puts what may not stand in a table before it."""
        depth = next(d for d in range(len(self.open) - 1, 0, -1) if self.open[d].tag == "table") if self.count["table"] else 0
        if not depth:
            self.open[-1].children.append(child)
        else:
            place = self.open[depth - 1].children
            place.insert(len(place) - 1, child)
        if isinstance(child, Node):
            child.parent = self.open[max(depth - 1, 0)] if depth else self.open[-1]
            if stays_open:
                self.open.append(child)
                self.count[child.tag] += 1

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag in HEADINGS:
            if depth := self.find(HEADINGS, SCOPES):
                self.pop_to(depth)
        elif tag == "p" and not self.find(("p",), SCOPES):
            self.start("p", {})
            self.end("p")
        elif tag not in ("html", "body"):
            inner = tag not in ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "template", "button")
            if depth := self.find((tag,), SCOPES if inner else ("template",) if tag == "table" else ("table", "template")):
                self.pop_to(depth)

    def text(self, text: str) -> None:
        here = self.open[-1].tag
        if here == "head":
            if not text.strip(SPACE):
                return
            self.pop_to(len(self.open) - 1)
            here = self.open[-1].tag
        if here in TABLE_PARTS and text.strip(SPACE):
            self.foster(text)
        else:
            self.open[-1].children.append(text)


def parse(source: str) -> Node:
    """Tree of a whole page."""
    tree, at, n = Tree(), 0, len(source)
    text_from = 0

    def text_to(end: int) -> None:
        if end > text_from:
            text = source[text_from:end]
            tree.text(html.unescape(text) if "&" in text else text)

    while (at := source.find("<", at)) >= 0:
        follows = source[at + 1 : at + 2]
        if follows == "!" or follows == "?":
            text_to(at)
            if source.startswith("<!--", at):
                # a comment may be closed at once: <!--> and <!--->
                end = re.compile(r"-?>").match(source, at + 4) or COMMENT_END.search(source, at + 4)
            else:
                end = TAG_END.match(source, at)
            at = text_from = end.end() if end else n
            continue
        closing = follows == "/"
        name = NAME.match(source, at + 1 + closing)
        if not name:
            if closing and source[at + 2 : at + 3]:  # </ before anything else is a comment
                text_to(at)
                end = TAG_END.match(source, at)
                at = text_from = end.end() if end else n
            else:
                at += 1
            continue
        text_to(at)
        tag, at = name.group().lower(), name.end()
        attributes: dict[str, str] = {}
        empty = False
        while source[at : at + 1] != ">":
            found = ATTRIBUTE.match(source, at)
            if not found:
                rest = TAG_END.match(source, at)
                at = rest.end() - 1 if rest else n
                empty = bool(rest) and rest.group().endswith("/>")
                break
            at = found.end()
            value = found[2] or ""
            attributes.setdefault(found[1].lower(), value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1 else value)
        if at >= n:
            text_from = n  # the page ends inside a tag, which is dropped
            break
        at += 1
        text_from = at
        if closing:
            tree.end(tag)
            continue
        tree.start(tag, attributes)
        if empty and tag not in VOID and (tree.count["svg"] or tree.count["math"]):
            tree.end(tag)  # in drawings and formulas a slash ends an element
        elif tag in ENDS:
            end = ENDS[tag].search(source, at)
            stop = end.start() if end else n
            if tag in RAW_WITH_ENTITIES and stop > at:
                tree.open[-1].children.append(html.unescape(source[at:stop]))
            elif tag == "xmp" and stop > at:
                tree.open[-1].children.append(source[at:stop])
            tree.end(tag)
            closed = TAG_END.match(source, stop) if end else None
            at = text_from = closed.end() if closed else n
        elif tag == "plaintext":
            tree.open[-1].children.append(source[at:])
            text_from = n
            break
    text_to(n)
    return tree.root


def hidden(node: Node) -> bool:
    """Whether a browser does not show an element, with all in it."""
    a = node.attributes
    if node.tag in UNSEEN or "hidden" in a or (node.tag == "dialog" and "open" not in a):
        return True
    return "style" in a and bool(NOT_DISPLAYED.search(html.unescape(a["style"])))


def visible(node: Node, inherited: bool) -> bool:
    """Whether text of an element shows, unless an element in it says otherwise."""
    stated = VISIBILITY.findall(html.unescape(node.attributes["style"])) if "style" in node.attributes else ()
    return stated[-1].lower() in ("visible", "initial") if stated else inherited


class Sink:
    """Text in the making: lines, and what must come before the next word."""

    def __init__(self):
        self.parts: list[str] = []
        self.breaks = 0
        self.space = False
        self.fresh = True  # nothing on the line yet
        self.indent = 0
        self.mark = ""

    def block(self, breaks: int) -> None:
        if self.parts:
            self.breaks = max(self.breaks, breaks)
        self.space = False

    def line_break(self) -> None:
        if self.parts:
            self.breaks = min(self.breaks + 1, 2)
        self.space = False

    def begin(self) -> None:
        """Breaks, indentation and the mark of a list item that wait for a word."""
        if self.breaks:
            self.parts.append("\n" * self.breaks)
            self.breaks, self.fresh = 0, True
        if self.fresh:
            self.parts.append("  " * (self.indent - (1 if self.mark else 0)) + self.mark)
            self.mark = ""
        elif self.space:
            self.parts.append(" ")
        self.space = self.fresh = False

    def text(self, text: str) -> None:
        words = COLLAPSE.sub(" ", text)
        inner = words.strip(" ")
        if not inner:
            self.space = self.space or not self.fresh and not self.breaks and bool(words)
            return
        self.space = (self.space or words[0] == " ") and not self.fresh
        self.begin()
        self.parts.append(inner)
        self.space = words[-1] == " "

    def verbatim(self, text: str) -> None:
        for i, line in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if i:
                self.breaks = self.breaks + 1 if self.parts else 0
            if line:
                self.begin()
                self.parts.append(line)

    def result(self) -> str:
        return "".join(self.parts)


COLLAPSE = re.compile(f"[{SPACE}]+")


class Table:
    def __init__(self):
        self.rows: list[list[str]] = []
        self.below: dict[int, int] = {}  # columns that a cell from above still covers, and for how many rows

    def new_row(self) -> None:
        self.rows.append([])
        self.skip()

    def skip(self) -> None:
        row = self.rows[-1]
        while self.below.get(len(row), 0) > 0:
            self.below[len(row)] -= 1
            row.append("")

    def cell(self, text: str, columns: int, rows: int) -> None:
        if not self.rows:
            self.new_row()
        for i in range(columns):
            if rows > 1:
                self.below[len(self.rows[-1])] = rows - 1
            self.rows[-1].append("" if i else text)
        self.skip()

    def lines(self) -> list[str]:
        """Cells of a column under each other, two blanks between columns."""
        widths: dict[int, int] = {}
        for row in self.rows:
            for i, cell in enumerate(row):
                widths[i] = max(widths.get(i, 0), len(cell))
        kept = [i for i, w in sorted(widths.items()) if w]  # columns with text
        padded = lambda row: [(row[i] if i < len(row) else "").ljust(widths[i] if widths[i] <= WIDEST else 0) for i in kept]
        return [line for row in self.rows if (line := "  ".join(padded(row)).rstrip(" "))]


def _span(node: Node, name: str, most: int) -> int:
    match = re.match(r"\s*(\d{1,6})", node.attributes.get(name, ""))
    return min(max(int(match[1]), 1), most) if match else 1


def render(root: Node) -> str:
    """Visible text of a tree."""
    sinks, tables, lists = [Sink()], [], []
    pre = 0
    # nodes, whether they are left, whether text around them shows, and the drawing, its text or the formula that they are in
    todo: list[tuple[Node | str, bool, bool, str]] = [(root, False, True, "")]
    while todo:
        node, leaving, shown, within = todo.pop()
        sink = sinks[-1]
        if isinstance(node, str):
            if not shown or within == "svg":
                continue
            sink.verbatim(node) if pre else sink.text(node)
            continue
        tag = node.tag
        if leaving:
            if tag == "table":
                lines = tables.pop().lines()
                sink.block(2)
                if lines:
                    sink.verbatim("\n".join(lines))
                sink.block(2)
            elif tag in ("td", "th") and tables:
                text = " ".join(sinks.pop().result().split())
                tables[-1].cell(text, _span(node, "colspan", MAX_COLSPAN), _span(node, "rowspan", MAX_ROWSPAN))
            elif tag in LISTS:
                lists.pop()
                sink.indent -= 1
                sink.block(2 if not sink.indent else 1)
            else:
                if tag == "li":
                    sink.mark = ""
                sink.block(2 if tag in MARGIN else 1)
                pre -= tag in PREFORMATTED
            continue
        if hidden(node) or tag in UNSEEN_IN.get(within.removesuffix(" text"), ()):
            continue
        shown = visible(node, shown)
        if tag in ("svg", "math"):
            within = tag
        elif within and tag in BREAKS_OUT:
            within = ""
        elif within == "svg" and tag == "text":
            within = "svg text"
            sink.block(1)
            todo.append((node, True, shown, within))
        elif within == "math" and tag in ("mtr", "mtd"):
            sink.text(" ")
        if tag == "br":
            sink.line_break()
            continue
        if tag in VOID:
            if tag == "hr":
                sink.block(2)
            elif tag == "input" and shown and node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
                sink.text(html.unescape(node.attributes.get("value", "")))
            continue
        children = node.children
        if tag == "details" and "open" not in node.attributes:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        laid_out = tag in BLOCK or tag in LISTS or (tag in ("td", "th") and tables) or tag in PREFORMATTED
        if tag == "table":
            tables.append(Table())
        elif tag == "tr" and tables:
            tables[-1].new_row()
            laid_out = False
        elif tag in ("td", "th") and tables:
            sinks.append(Sink())
        elif tag in ("thead", "tbody", "tfoot") and tables:
            laid_out = False
        elif tag in LISTS:
            number = re.match(r"\s*(-?\d{1,9})", node.attributes.get("start", ""))
            lists.append([tag, int(number[1]) if number else 1])
            sink.block(2 if not sink.indent else 1)
            sink.indent += 1
        elif tag in BLOCK or tag in PREFORMATTED:
            sink.block(2 if tag in MARGIN else 1)
            if tag == "li":
                value = re.match(r"\s*(-?\d{1,9})", node.attributes.get("value", ""))
                if lists and lists[-1][0] == "ol":
                    lists[-1][1] = int(value[1]) if value else lists[-1][1]
                    sink.mark = f"{lists[-1][1]}. " if shown else ""
                    lists[-1][1] += 1
                else:
                    sink.mark = "- " if shown else ""
            if tag in PREFORMATTED:
                pre += 1
                if tag != "xmp" and children and isinstance(children[0], str):  # a line break right behind the tag does not count
                    children = [children[0].removeprefix("\r").removeprefix("\n"), *children[1:]]
        if laid_out:
            todo.append((node, True, shown, within))
        todo.extend((c, False, shown, within) for c in reversed(children))
    return sinks[0].result()


def page_text(source: str | None) -> str:
    """Visible text of a page; empty for null."""
    return render(parse(source)) if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id and text (all visible text of the whole page), one row per row of pages.

    pages: page_id, html; other columns are left aside. Null and empty pages, and pages that show nothing, have an empty text.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(rows, 1):
            texts = [page_text(x.as_py()) for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["page_id", "text"])

    return pages.select(F.col("page_id").cast("bigint"), F.col("html")).mapInArrow(run, "page_id bigint, text string")
