"""Visible text of HTML pages, laid out.

A tree builder with implied end tags makes the element tree; visibility rules
drop what a browser does not show; a renderer keeps block spacing, list markers
and indents, preformatted text, and tables with aligned cells.

A null or empty page gives an empty text. Unclosed tags, comments and quotes
end with the page. Rows are rendered one by one, so repeated pages and ids are
of no account. Pages go through Python in small batches.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title template".split())
UNSEEN = frozenset(
    "head script style template noscript iframe noembed noframes title meta link base object audio video canvas datalist annotation annotation-xml mphantom".split()
)
PARAGRAPHS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure article section fieldset form address details hr menu".split()
)
BLOCKS = PARAGRAPHS | frozenset(
    "html body div header footer main nav aside li dt dd tr caption figcaption legend summary center dialog hgroup option optgroup".split()
)
CLOSES_P = (PARAGRAPHS | frozenset("div header footer main nav aside li dt dd center summary dialog hgroup".split())) - {"caption"}
TABLE_PARTS = frozenset("thead tbody tfoot tr td th caption colgroup col".split())
SCOPE = frozenset("table td th caption html body".split())
# Which open elements a start tag ends, and where the search for them stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist", "table"}),
    "optgroup": ({"option", "optgroup"}, {"select", "table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}

TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?+")
HIDING = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
DECLARED = re.compile(r"(?:^|[;\s])(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
PIECE = re.compile(r"[^{};]*+[{};]?")
# The screen that media queries are judged by, in pixels.
SCREEN = {"width": 1280.0, "height": 800.0}
MEDIA = re.compile(r"\(\s*(min|max)-(width|height)\s*:\s*([\d.]+)(px|em|rem)\s*\)")
# What SVG draws nothing of by itself.
SVG_UNSEEN = frozenset("defs symbol clippath mask pattern marker desc metadata".split())
SIMPLE = re.compile(r"[.#]?[\w-]+")
GAPS = re.compile(r"[ \t\n\r\f]+")
# Elements kept apart from their neighbours by a space.
SPACED = frozenset(["td", "th", "button", "text", "mtd", "mtr"])
# Tables nested deeper than this are rendered as plain blocks.
TABLE_DEPTH = 40


def on_screen(query: str) -> bool:
    """Whether one query of a media list holds on the screen; one with features not known here does not."""
    query = " ".join(query.lower().split())
    if query.startswith("not "):
        return query[4:].strip() in ("print", "speech")
    for part in query.removeprefix("only ").split(" and "):
        if part.strip() in ("all", "screen", ""):
            continue
        found = MEDIA.fullmatch(part.strip())
        if not found:
            return False
        bound = float(found[3]) * (1 if found[4] == "px" else 16) if found[3].count(".") < 2 and found[3] != "." else 0.0
        if SCREEN[found[2]] < bound if found[1] == "min" else SCREEN[found[2]] > bound:
            return False
    return True


def applies(rule: str) -> bool:
    """Whether the rules in an at-rule's block hold on a screen."""
    name, _, rest = rule.strip().partition(" ")
    if name.lower().startswith("@media"):
        return any(on_screen(q) for q in (name[6:] + " " + rest).split(","))
    return name.lower() == "@layer" or (name.lower() == "@supports" and "not" not in rest.lower().split())


def sheet_rules(css: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations of the rules that hold on a screen, in order."""
    held: list[bool] = []  # of every open at-rule
    selectors, body = None, ""
    for piece in PIECE.findall(COMMENT.sub(" ", css)):
        if selectors is not None:
            body += piece.rstrip("}{")
            if piece.endswith("}"):
                if all(held):
                    yield selectors, body
                selectors, body = None, ""
        elif piece.endswith("{"):
            head = piece[:-1].strip()
            if head.startswith("@"):
                held.append(applies(head))
            else:
                selectors = head
        elif piece.endswith("}") and held:
            held.pop()
    if selectors is not None and all(held):
        yield selectors, body  # the sheet ends in a rule


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def attributes_of(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


class TreeBuilder:
    """Builds the element tree of a page; ``hidden`` gathers simple selectors that style sheets hide."""

    def __init__(self) -> None:
        self.root = Node("html", {})
        self.open = [self.root]
        self.hidden: set[str] = set()
        self.declared: dict[tuple[str, str], tuple[bool, bool]] = {}
        self.foreign = False

    def add(self, item: Node | str) -> None:
        """Put text or an element in place; what may not stand in a table goes before it."""
        at = self.open[-1]
        misplaced = at.tag in {"table", "thead", "tbody", "tfoot", "tr"} and (
            item.strip() != "" if isinstance(item, str) else item.tag not in TABLE_PARTS
        )
        if misplaced:
            k = max(i for i, n in enumerate(self.open) if n.tag == "table") if any(n.tag == "table" for n in self.open) else 0
            if k:
                siblings = self.open[k - 1].children
                siblings.insert(len(siblings) - 1, item)
                return
        at.children.append(item)

    def pop_to(self, tags: set[str], stop: set[str] | frozenset[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in stop:
                return

    def in_foreign(self) -> bool:
        """Whether the place is in svg or math, where a tag may close itself."""
        for node in reversed(self.open):
            if node.tag in ("svg", "math"):
                return True
            if node.tag == "foreignobject":
                return False
        return False

    def start(self, tag: str, attributes: dict[str, str], closed: bool = False) -> None:
        if tag == "html":
            for name, value in attributes.items():
                self.root.attributes.setdefault(name, value)
            return
        if tag in CLOSES_P:
            self.pop_to({"p"}, SCOPE)
        if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", self.open[-1].tag):
            self.open.pop()
        if tag in ENDS:
            tags, stop = ENDS[tag]
            for _ in range(3):  # cell, row and section may all end
                self.pop_to(tags, stop)
        node = Node(tag, attributes)
        self.add(node)
        self.foreign |= tag in ("svg", "math")
        if tag not in VOID and not closed:
            self.open.append(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.add(Node("br", {}))
        elif tag not in ("html", "body"):
            barrier = {"table"} if tag in TABLE_PARTS else set() if tag == "table" else SCOPE | ({"ul", "ol"} if tag == "li" else set())
            self.pop_to({tag}, barrier)

    def feed(self, page: str) -> Node:
        at, size, quotes = 0, len(page), True
        while at < size:
            less = page.find("<", at)
            if less < 0:
                less = size
            if less > at:
                self.add(html.unescape(page[at:less]))
            if less == size:
                break
            at = less
            if page.startswith("<!--", at):
                stop = page.find("-->", at + 4)
                at = size if stop < 0 else stop + 3
                continue
            if page[at + 1 : at + 2] in ("!", "?"):
                stop = page.find(">", at)
                at = size if stop < 0 else stop + 1
                continue
            found = TAG.match(page, at) if quotes else None
            if found is None:
                name = NAME.match(page, at)
                stop = page.find(">", at) if name else -1
                if name is None:
                    self.add("<")
                    at += 1
                    continue
                if stop < 0:
                    break  # the page ends in a tag
                quotes = False
                tag, source, after = name[1].lower(), page[name.end() : stop], stop + 1
            else:
                tag, source, after = found[1].lower(), found[2], found.end()
            if page[at + 1] == "/":
                self.end(tag)
            else:
                closed = source.endswith("/") and (tag in ("svg", "math") or (self.foreign and self.in_foreign()))
                self.start(tag, attributes_of(source) if source else {}, closed)
                if tag in RAW and not closed:
                    after = self.raw(page, tag, after)
            at = after
        return self.root

    def style(self, css: str, media: str) -> None:
        """Take a style sheet: of one selector's declarations of a property the last holds, important ones before others."""
        if not any(on_screen(q) for q in media.split(",")):
            return
        for selectors, body in sheet_rules(css):
            found = DECLARED.findall(body)
            for selector in selectors.split(",") if found else ():
                selector = selector.strip().lower()
                if not SIMPLE.fullmatch(selector):
                    continue
                for name, value, important in found:
                    key = (selector, name.lower())
                    if important or not self.declared.get(key, (False, False))[1]:
                        self.declared[key] = (value.lower() in ("none", "hidden", "collapse"), bool(important))
        self.hidden = {selector for (selector, _), (hides, _) in self.declared.items() if hides}

    def raw(self, page: str, tag: str, at: int) -> int:
        """Take the text up to the end tag as it is; return where it ends."""
        found = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
        stop, after = (found.start(), found.end()) if found else (len(page), len(page))
        text = page[at:stop]
        if tag in ("textarea", "title"):
            text = html.unescape(text)
        if tag == "style":
            self.style(text, self.open[-1].attributes.get("media", ""))
        if text:
            self.open[-1].children.append(text)
        self.open.pop()
        return after


def shown(node: Node, hidden: set[str]) -> bool:
    """Whether a browser shows the element."""
    a = node.attributes
    if node.tag in UNSEEN:
        return False
    if not a and not hidden:
        return node.tag != "dialog"
    if "hidden" in a or HIDING.search(a.get("style", "")) or (node.tag == "dialog" and "open" not in a):
        return False
    if node.tag == "input":
        return False
    if hidden:
        names = {node.tag, "#" + a.get("id", "").lower(), *("." + c.lower() for c in a.get("class", "").split())}
        return not names & hidden
    return True


def svg_text(root: Node, hidden: set[str]) -> list[Node]:
    """What an SVG drawing shows as text: its text elements and HTML parts."""
    found, todo = [], list(reversed(root.children))
    while todo:
        node = todo.pop()
        if isinstance(node, str) or node.tag in SVG_UNSEEN or not shown(node, hidden):
            continue
        if node.attributes.get("display") == "none" or node.attributes.get("visibility") in ("hidden", "collapse"):
            continue
        if node.tag in ("text", "foreignobject"):
            found.append(node)
        else:
            todo += reversed(node.children)
    return found


def width(text: str) -> int:
    """Columns that a line takes."""
    if text.isascii():
        return len(text)
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 0 if unicodedata.combining(c) else 1 for c in text)


class Renderer:
    """Lays the shown text of an element out in lines."""

    def __init__(self, hidden: set[str], depth: int = 0):
        self.hidden, self.depth = hidden, depth
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.indent = ""
        self.marker = ""

    def flush(self, gap: int) -> None:
        """End the line; the next text comes on a new line (1) or after an empty one (2)."""
        text = "".join(self.line).rstrip(" ")
        if text:
            self.write(text)
        self.line = []
        self.gap = max(self.gap, gap)

    def write(self, text: str) -> None:
        if self.gap == 2 and self.lines:
            self.lines.append("")
        self.gap = 1
        head = self.indent
        if self.marker:
            head = self.indent[: len(self.indent) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((head + text).rstrip())

    def text(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.line.append(first)
            for part in rest:
                self.write("".join(self.line))
                self.line = [part]
            return
        text = GAPS.sub(" ", text)
        if text.startswith(" ") and (not self.line or self.line[-1].endswith(" ")):
            text = text[1:]
        if text:
            self.line.append(text)

    def run(self, root: Node) -> list[str]:
        lists: list[list] = []
        pre = 0
        todo: list = [iter(root.children)]
        ends: list = [None]
        while todo:
            item = next(todo[-1], None)
            if item is None:
                todo.pop()
                end = ends.pop()
                if end:
                    end()
                continue
            if isinstance(item, str):
                self.text(item, pre > 0)
                continue
            tag = item.tag
            if not shown(item, self.hidden):
                continue
            if tag == "br":
                self.write("".join(self.line).rstrip(" ")) if self.line or self.lines else None
                self.line = []
                continue
            if tag == "table" and self.depth < TABLE_DEPTH:
                self.flush(2)
                for line in self.table(item):
                    self.write(line)
                self.flush(2)
                continue
            children = item.children
            if tag == "svg":
                children = svg_text(item, self.hidden)
            if tag == "details" and "open" not in item.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            gap = 2 if tag in PARAGRAPHS and not (tag in ("ul", "ol", "menu") and lists) else 1 if tag in BLOCKS else 0
            if gap:
                self.flush(gap)
            before = self.indent
            if tag in ("ul", "ol", "menu"):
                first = item.attributes.get("start", "1")
                lists.append([tag, int(first) if re.fullmatch(r"-?\d{1,9}", first) else 1])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1]
                self.marker = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
                self.indent += " " * len(self.marker)
            elif tag in ("dd", "blockquote"):
                self.indent += "  "
            elif tag in ("pre", "textarea"):
                pre += 1
            elif tag in SPACED:
                self.text(" ", False)

            def leave(tag=tag, gap=gap, before=before):
                nonlocal pre
                if gap:
                    self.flush(gap)
                if tag in ("ul", "ol", "menu"):
                    lists.pop()
                elif tag in ("pre", "textarea"):
                    pre -= 1
                elif tag == "li":
                    self.marker = ""
                elif tag in SPACED:
                    self.text(" ", False)
                self.indent = before

            todo.append(iter(children))
            ends.append(leave)
        self.flush(0)
        return self.lines

    def table(self, root: Node) -> list[str]:
        """A table's lines: each cell rendered by itself, columns padded to one width."""
        lines: list[str] = []
        rows: list[list[list[str]]] = []
        held: dict[int, int] = {}
        todo = list(reversed(root.children))
        while todo:
            node = todo.pop()
            if isinstance(node, str) or not shown(node, self.hidden):
                continue
            if node.tag == "caption":
                lines += Renderer(self.hidden, self.depth + 1).run(node)
            elif node.tag in ("thead", "tbody", "tfoot"):
                todo += reversed(node.children)
            elif node.tag in ("tr", "td", "th"):
                cells = [c for c in (node.children if node.tag == "tr" else [node]) if isinstance(c, Node) and shown(c, self.hidden)]
                row: list[list[str]] = []
                for cell in cells:
                    while held.get(len(row), 0) > 0:
                        held[len(row)] -= 1
                        row.append([])
                    down, across = (min(1000, int(v)) if (v := cell.attributes.get(k, "1")).isascii() and v.isdigit() and v != "0" else 1 for k in ("rowspan", "colspan"))
                    for k in range(across):
                        held[len(row)] = down - 1
                        row.append(Renderer(self.hidden, self.depth + 1).run(cell) if k == 0 else [])
                while held.get(len(row), 0) > 0:
                    held[len(row)] -= 1
                    row.append([])
                rows.append(row)
        columns = max((len(r) for r in rows), default=0)
        widths = [max((width(line) for r in rows if k < len(r) for line in r[k]), default=0) for k in range(columns)]
        for row in rows:
            for k in range(max((len(cell) for cell in row), default=0)):
                parts = [cell[k] if k < len(cell) else "" for cell in row]
                lines.append(" | ".join(p + " " * (w - width(p)) for p, w in zip(parts, widths, strict=False)).rstrip())
        return lines


def visible_text(page: str) -> str:
    """The visible text of one page."""
    builder = TreeBuilder()
    root = builder.feed(page)
    return "\n".join(Renderer(builder.hidden).run(root)).strip("\n")


def rendered(pages: DataFrame, key: str = "page_id", column: str = "html") -> DataFrame:
    """Key and visible text of every page."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "text": batch["page"].map(visible_text)})

    return pages.select(key, F.coalesce(F.col(column), F.lit("")).alias("page")).mapInPandas(run, f"{key} {kind}, text string")
