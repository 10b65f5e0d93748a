"""Layout-aware rendering of HTML to text.

A page is parsed into a tree with the usual implied tags (a ``p`` ends where
a block begins, ``li`` ends the item before it, cells and rows end each
other, a cell without a row begins one, and so on), and the tree is rendered: everything visible, in order,
with blank lines between paragraphs, list markers with indentation, table
cells aligned in columns, and ``pre`` kept as it is. A cell is laid out like a
page of its own, nested tables too, and its lines are aligned with those of its
neighbours; lines over ``WIDE`` characters are wrapped at spaces, but not in the
last column.

Pages are rendered one by one inside Arrow batches; nothing is shuffled.

Defined results: null or empty HTML gives an empty text; text outside any tag
is text of the body; unclosed tags end with the page; repeated rows are
rendered each; an empty table gives an empty result; other columns than those
named are ignored. Hidden are head, scripts, styles, templates and the like,
elements with ``hidden``, inline ``display:none`` or ``visibility:hidden``, and
what a page's own style sheet hides by a single tag, class or id on any screen;
what is hidden in print or under a condition such as a width stays.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Generator, Iterable, Iterator
from html import unescape
from textwrap import TextWrapper

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("head script style template noscript title iframe object audio video canvas datalist noembed noframes".split())
#: What isn't shown inside svg and math only.
UNSEEN_IN = {"svg": set("defs desc metadata symbol clippath mask marker pattern lineargradient radialgradient filter".split()), "math": {"annotation", "annotation-xml"}}
#: Blocks with a blank line around them, and those on lines of their own.
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre xmp figure hr fieldset".split())
BLOCKS = SPACED | set("address article aside body caption center dd details dialog div dt fieldset figcaption footer form header hgroup html legend li main menu nav option section summary tr".split())
ENDS_P = BLOCKS - {"html", "body", "tr", "caption", "option", "legend"}
#: Which open elements a start tag ends, and where looking for them stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "a": ({"a"}, {"td", "th", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "body": ({"head"}, set()),
}
SCOPE = {"td", "th", "caption", "table", "html", "button", "template"}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
HIDES = re.compile(r"\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
CSS_NOISE = re.compile(r"/\*.*?(?:\*/|\Z)|\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+'|<!--|-->", re.S)
#: Longest line of a cell beside others before it is wrapped, and the widest a column gets where a single word is longer.
WIDE, WIDEST = 60, 1000


def on_screen(media: str) -> bool:
    """Whether a media query holds on every screen."""
    queries = [" ".join(q.lower().split()) for q in media.split(",")]
    return not media.strip() or any(q in ("all", "screen", "only all", "only screen") or (q.startswith("not ") and q[4:].isalpha() and q[4:] not in ("all", "screen")) for q in queries)


def hidden_by(style: str) -> set[str]:
    """The selectors that a style sheet hides on every screen."""
    out: set[str] = set()
    #: Of each open block: whether it holds, and its selectors, None for a block of rules.
    blocks: list[tuple[bool, list[str] | None]] = []
    style, at = CSS_NOISE.sub(" ", style), 0
    for m in re.finditer(r"[{};]|\Z", style):
        part, at = style[at : m.start()].strip(), m.end()
        holds, own = blocks[-1] if blocks else (True, None)
        if m[0] == "{":
            if part.startswith("@"):
                name, _, rest = part[1:].replace("(", " (", 1).partition(" ")
                blocks.append((holds and (name.lower() in ("supports", "layer") or (name.lower() == "media" and on_screen(rest))), None))
            else:  # a rule inside a rule hides only some of what it names
                blocks.append((holds and own is None, [x.strip().lower() for x in part.split(",")]))
            continue
        if own and holds and HIDES.match(part):
            out.update(own)
        if m[0] == "}" and blocks:
            blocks.pop()
    return out


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes, self.children = tag, attributes, []


def parse(html: str) -> tuple[Node, set[str]]:
    """The tree, and the selectors that its style sheets hide."""
    root = Node("html", {})
    stack, hidden, at, n = [root], set(), 0, len(html)
    #: Where the open elements of a name are on the stack, so that a tag costs the same at any depth; 0 stands for none.
    places: dict[str, list[int]] = defaultdict(list)

    def last(names: Iterable[str]) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=0)

    def shut(to: int) -> None:
        while len(stack) > to:
            places[stack.pop().tag].pop()

    def end(names: set[str], stop: set[str]) -> None:
        while (found := last(names)) and found >= last(stop):
            shut(found)

    while at < n:
        start = html.find("<", at)
        if start < 0:
            start = n
        if start > at:
            stack[-1].children.append(unescape(html[at:start]) if "&" in html[at:start] else html[at:start])
        if start == n:
            break
        m = TAG.match(html, start) or LOOSE.match(html, start)
        if not m:
            stack[-1].children.append("<")
            at = start + 1
            continue
        at = m.end()
        if not m.lastindex or m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not last(["p"]):
                stack[-1].children.append(Node("p", {}))
            else:
                stop = set() if tag in SCOPE or tag in ("body", "html") else {"td", "th", "table"} - {tag}
                if (found := last([tag])) > last(stop):
                    shut(found)
            continue
        if tag == "html" or (tag == "body" and last(["body"])):
            continue
        foreign = stack[found].tag if (found := last(UNSEEN_IN)) else None
        attributes = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTRIBUTE.findall(m[3])} if m[3].strip("/ \n\t") else {}
        if tag in ENDS_P:
            end({"p"}, SCOPE)
        if tag in CLOSES:
            end(*CLOSES[tag])
        if tag in ("td", "th") and last(["table"]) > last(["tr"]):
            row = Node("tr", {})
            stack[-1].children.append(row)
            places["tr"].append(len(stack))
            stack.append(row)
        if stack[-1].tag == "head" and tag not in RAW | VOID | {"noscript", "template"}:
            shut(len(stack) - 1)
        if foreign and tag in UNSEEN_IN[foreign]:
            attributes["hidden"] = ""
        if foreign == "svg" and tag == "text":  # stands at a place of its own
            stack[-1].children.append(" ")
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if (foreign or tag in UNSEEN_IN) and m[3].endswith("/"):
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            text = html[at : close.start() if close else n]
            if tag == "style":
                if on_screen(attributes.get("media", "")):
                    hidden |= hidden_by(text)
            elif tag == "xmp":
                node.children.append(text)
            elif tag == "textarea":
                node.children.append(unescape(text))
            at = close.end() if close else n
        elif tag not in VOID:
            places[tag].append(len(stack))
            stack.append(node)
    return root, hidden


class Renderer:
    def __init__(self, hidden: set[str]) -> None:
        self.hidden = hidden
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False
        #: Indentation of the open line, from where it began.
        self.indent = ""

    def shown(self, node: Node) -> bool:
        a = node.attributes
        if node.tag in UNSEEN or "hidden" in a or (node.tag == "input"):
            return False
        if self.hidden and (node.tag in self.hidden or "#" + a.get("id", "").lower() in self.hidden or any("." + c in self.hidden for c in a.get("class", "").lower().split())):
            return False
        style = a.get("style", "").replace(" ", "").lower()
        return "display:none" not in style and "visibility:hidden" not in style

    def say(self, text: str, indent: str) -> None:
        if not self.line:
            self.indent = indent
        self.line.append(text)

    def end_line(self) -> None:
        text = " ".join("".join(self.line).split())
        self.line.clear()
        if text:
            if self.blank and self.lines:
                self.lines.append("")
            self.lines.append(self.indent + text)
            self.blank = False

    def walk(self, root: Node) -> Generator[Node, list[str], list[str]]:
        """Lines of a node; yields cells and is sent their lines.

        Renders without recursion, so depth is no limit. A task on the stack is (node, indent, number) or (None, what to do).
        """
        todo: list[tuple] = [(root, "", None)]
        while todo:
            node, indent, number = todo.pop()
            if isinstance(node, str):
                if self.line or node.strip():
                    self.say(node, indent)
                continue
            if node is None:
                self.end_line()
                self.blank = self.blank or number
                continue
            if not self.shown(node):
                continue
            tag = node.tag
            if tag == "br":
                self.end_line()
            elif tag == "img":
                self.say(" " + node.attributes.get("alt", "") + " ", indent)
            elif tag == "table":
                self.end_line()
                self.blank = True
                for row in (yield from self.table(node)):
                    if self.blank and self.lines:
                        self.lines.append("")
                    self.lines.append(indent + row if row else "")
                    self.blank = False
                self.blank = True
            elif tag in ("pre", "xmp"):
                self.end_line()
                if self.lines:
                    self.lines.append("")
                self.lines += [indent + x.rstrip() for x in self.plain(node, keep=True).strip("\n").split("\n")]
                self.blank = True
            else:
                block, spaced = tag in BLOCKS, tag in SPACED
                inner = indent
                if block:
                    self.end_line()
                    self.blank = self.blank or (spaced and not (tag in ("ul", "ol") and indent))
                    todo.append((None, indent, spaced and not (tag in ("ul", "ol") and indent)))
                if tag == "li":
                    self.say(f"{number}. " if number is not None else "- ", indent)
                elif tag in ("dd", "blockquote"):
                    inner = indent + "  "
                    todo.append((None, inner, False))
                count = int(node.attributes["start"]) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", node.attributes.get("start") or "") else 1
                own = []
                for child in node.children:
                    if isinstance(child, Node) and child.tag == "li":
                        own.append((child, indent, count if tag == "ol" else None))
                        count += tag == "ol"
                    else:
                        own.append((child, inner + ("  " if tag == "li" and isinstance(child, Node) and child.tag in ("ul", "ol") else ""), None))
                if tag in ("svg", "td", "th"):
                    own = [(" ", inner, None), *own, (" ", inner, None)]
                todo.extend(reversed(own))
        self.end_line()
        return self.lines

    def plain(self, root: Node, keep: bool = False) -> str:
        """All visible text under a node, on one line unless kept as it is."""
        out, todo = [], [root]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)
            elif self.shown(node):
                if node.tag == "br":
                    out.append("\n")
                elif node.tag == "img":
                    out.append(" " + node.attributes.get("alt", "") + " ")
                todo.extend([" ", *reversed(node.children), " "] if node.tag in BLOCKS | {"td", "th"} and not keep else reversed(node.children))
        return "".join(out) if keep else " ".join("".join(out).split())

    def cell(self, node: Node | str) -> Generator[Node, list[str], list[str]]:
        """Lines of what stands in a row or table."""
        if isinstance(node, Node) and not self.shown(node):
            return []
        texts = [node] if isinstance(node, str) else node.children
        if any(isinstance(x, Node) for x in texts) or (isinstance(node, Node) and node.tag in ("pre", "xmp")):
            return (yield node)
        text = " ".join("".join(texts).split())
        return [text] if text else []

    def table(self, table: Node) -> Generator[Node, list[str], list[str]]:
        rows: list[dict[int, list[str]]] = []
        captions: list[str] = []
        #: Column -> the last row that a cell from above takes there.
        taken: dict[int, int] = {}
        todo: list = list(reversed(table.children))
        while todo:
            node = todo.pop()
            if node is None:  # cells end with their group of rows
                taken.clear()
            elif isinstance(node, str):
                captions += yield from self.cell(node)
            elif node.tag == "tr":
                if self.shown(node):
                    row, at = {}, 0
                    for cell in node.children:
                        lines = yield from self.cell(cell)
                        own = isinstance(cell, Node) and cell.tag in ("td", "th")
                        if not own and not lines:
                            continue
                        while taken.get(at, -1) >= len(rows):
                            at += 1
                        row[at] = lines
                        wide, high = (self.span(cell, "colspan"), self.span(cell, "rowspan")) if own else (1, 1)
                        for _ in range(min(wide or 1, 100)):
                            if high != 1:
                                taken[at] = len(rows) + high - 1 if high else 1 << 30  # 0: as long as the group
                            at += 1
                    rows.append(row)
            elif self.shown(node):
                if node.tag in ("thead", "tbody", "tfoot"):
                    todo += [None, *reversed(node.children), None]
                elif node.tag == "form":
                    todo.extend(reversed(node.children))
                else:
                    captions += yield from self.cell(node)
        return captions + aligned(rows)

    @staticmethod
    def span(cell: Node, name: str) -> int:
        span = cell.attributes.get(name) or "1"
        return int(span) if re.fullmatch(r"\d{1,5}", span) else 1


def aligned(rows: list[dict[int, list[str]]]) -> list[str]:
    """Lines of rows, each of which has the lines of its cells by column."""
    last = max((i for row in rows for i, lines in row.items() if lines), default=-1)
    widths = [0] * (last + 1)
    for row in rows:
        for i, lines in row.items():
            if i < last and lines:
                row[i] = lines = [x for line in lines for x in wrapped(line)]
                widths[i] = max(widths[i], min(max(map(len, lines)), WIDEST))
    out = []
    for row in rows:
        for k in range(max(map(len, row.values()), default=0)):
            texts = {i: lines[k] for i, lines in row.items() if k < len(lines) and lines[k]}
            out.append(" | ".join(texts.get(i, "").ljust(widths[i]) for i in range(max(texts, default=-1) + 1)).rstrip())
    return out


def wrapped(line: str) -> list[str]:
    if len(line) <= WIDE:
        return [line]
    indent = line[: len(line) - len(line.lstrip())]
    return TextWrapper(WIDE, subsequent_indent=indent, expand_tabs=False, replace_whitespace=False, break_long_words=False, break_on_hyphens=False).wrap(line) or [""]


def render(html: str | None) -> str:
    root, hidden = parse(html or "")
    open_cells, lines = [Renderer(hidden).walk(root)], None
    while open_cells:
        try:
            cell = open_cells[-1].send(lines)
            open_cells.append(Renderer(hidden).walk(cell))
            lines = None
        except StopIteration as done:
            open_cells.pop()
            lines = done.value
    return "\n".join(lines)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text, n_lines) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], ["id", "text", "n_lines"])

    rows = pages.select(id_col, html_col)
    return rows.mapInArrow(run, f"id {pages.schema[id_col].dataType.simpleString()}, text string, n_lines long").withColumnRenamed("id", id_col)
