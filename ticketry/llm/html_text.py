"""HTML extraction by layout: a tree with implied tags, visibility rules, and a text renderer.

All visible text comes out, as it would stand on the screen: blocks on lines of their own,
paragraphs apart by an empty line, list items with marks and indents, table cells in columns.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import free_name

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Content is text up to the end tag, whatever it looks like.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template noscript title iframe noembed noframes object audio video canvas"
    " datalist dialog".split()
)
#: Elements of a drawing and of a formula that show nothing.
UNSHOWN = {
    "svg": frozenset("desc metadata defs symbol clippath mask marker pattern".split()),
    "math": frozenset(("annotation", "annotation-xml")),
}
#: Blocks with an empty line around them, and blocks on lines of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside header footer nav main address form li dt dd caption"
    " figcaption details summary center option legend tr optgroup xmp".split()
)
CLOSES_P = (BLOCK - {"tr", "caption", "option", "html", "body", "optgroup", "legend"}) | {"hr"}
CELLS, PARTS = ("td", "th"), ("thead", "tbody", "tfoot")
#: Open elements that the parts of a table may start in; others between them and the table end.
INSIDE = {
    **{c: ("tr", *PARTS, "table") for c in CELLS}, "tr": (*PARTS, "table"), "col": ("colgroup", "table"),
    **{p: ("table",) for p in (*PARTS, "caption", "colgroup")},
}
#: Directly in these, what is no part of a table stands before the table.
FOSTERS = frozenset(("table", *PARTS, "tr", "colgroup"))
#: Edges of what a part of a table belongs to.
MARKS = frozenset(("table", *CELLS, "caption", "template"))
#: A start tag ends open elements of these names, unless one of the others stands in between.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("optgroup", "option"), ("select", "datalist")),
    "td": (CELLS, ("table", "template")), "th": (CELLS, ("table", "template")),
    "tr": (("tr", "caption"), ("table", "template")),
    **{p: ((*PARTS, "caption", "colgroup"), ("table", "template")) for p in PARTS},
    "body": (("head",), ()),
}
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
#: Up to the end of a tag or a value; a quote opens a value behind an equals sign only.
PLAIN = re.compile(r"[^>=]*+(?:=[ \t\n\f\r]*+)?")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
BLANKS = re.compile(r"[ \t\n\f\r]+")
HIDING = {"display": ("none",), "visibility": ("hidden", "collapse")}
NO_STYLE = re.compile(r"""/\*.*?(?:\*/|\Z)|"[^"\n]*"|'[^'\n]*'|<!--|-->""", re.S)
EDGE = re.compile(r"[{};]")
FEATURE = re.compile(r"\(\s*(min-|max-)?(width|height)\s*:\s*(\d*\.?\d+)\s*(px|r?em)?\s*\)$")
#: The screen that conditions of style sheets are judged by.
SCREEN = {"width": 1280, "height": 720}
SELECTOR = re.compile(r"(?:[a-z][a-z0-9]*|[.#][\w-]+)$", re.I)


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str]) -> None:
        self.name, self.attributes, self.children = name, attributes, []


def _tag_end(html: str, at: int) -> int:
    """Where the tag whose name ends at ``at`` has its end; -1 if the page ends before."""
    while True:
        at = PLAIN.match(html, at).end()
        sign = html[at : at + 1]
        if sign == ">":
            return at
        if not sign:
            return -1
        if sign in "\"'" and html[at - 1] in "= \t\n\f\r":
            at = html.find(sign, at + 1)
            if at < 0:
                return -1
            at += 1


def tokens(html: str):
    """("text", text, "") or ("start" or "end", name, attributes), left to right, once over.

    A tag that the page ends in, or whose last value never ends, takes the rest of the page along, as on
    a screen; so no sign is looked at from two tags.
    """
    at, size = 0, len(html)
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            yield "text", html[at:], ""
            return
        if mark > at:
            yield "text", html[at:mark], ""
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        found = TAG.match(html, mark)
        if found:
            end = _tag_end(html, found.end())
            if end < 0:
                return
            at, name = end + 1, found[2].lower()
            yield ("end" if found[1] else "start"), name, html[found.end() : end]
            if not found[1] and name in RAW:
                close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
                end = close.start() if close else size
                yield "raw", html[at:end], name
                at = end
            continue
        follow = html[mark + 1 : mark + 2]
        if follow and follow in "!?/":
            end = html.find(">", mark)
            at = size if end < 0 else end + 1  # a broken tag shows nothing
        else:
            yield "text", "<", ""
            at = mark + 1


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(value.strip("\"'")))
    return out


class Rules(dict):
    """Simple selector -> property -> (important, kind of selector, place, hides) of the rule that wins."""

    read = 0


def _holds(condition: str) -> bool:
    """Whether a media condition holds for the screen; one that is not understood does not."""
    for query in condition.lower().split(","):
        query = " ".join(query.split()).removeprefix("only ")
        turned = query.startswith("not ")
        found = []
        for part in query[4 * turned :].split(" and "):
            feature = FEATURE.match(part)
            if feature:
                bound, name, number, unit = feature.groups()
                size = float(number) * (16 if unit in ("em", "rem") else 1)
                have = SCREEN[name]
                found.append(have >= size if bound == "min-" else have <= size if bound else have == size)
            elif part.strip("() ") in ("orientation: landscape", "orientation:landscape"):
                found.append(True)
            else:
                found.append(part in ("", "all", "screen") if part.isalpha() or not part else None)
        if None not in found and all(found) != turned:
            return True
    return False


def _declared(body: str) -> dict[str, tuple[bool, bool]]:
    """(important, hides) of ``display`` and ``visibility``, as the last declaration says."""
    out: dict[str, tuple[bool, bool]] = {}
    for declaration in body.lower().split(";"):
        name, _, value = declaration.partition(":")
        name = name.strip()
        if name in HIDING:
            value, mark, _ = value.partition("!")
            if not (name in out and out[name][0]) or mark:
                out[name] = bool(mark), value.strip() in HIDING[name]
    return out


def _read_style(sheet: str, rules: Rules) -> None:
    """Add what the rules that hold for the screen say of simple selectors; the last one wins.

    Blocks of at-rules are read if their condition holds; rules inside rules are passed over.
    """
    sheet = NO_STYLE.sub(" ", sheet)
    blocks: list[str] = []  # of open blocks: read, passed or the selectors of a rule
    own: list[str] = []  # declarations of the open rule
    at = 0
    for edge in EDGE.finditer(sheet):
        before, at = sheet[at : edge.start()].strip(), edge.end()
        inside = blocks[-1] if blocks else "@read"
        if edge[0] == "{":
            if inside != "@read":
                blocks.append("@passed")
            elif before.startswith("@"):
                kind, condition = (*before[1:].lower().replace("(", " (", 1).split(None, 1), "", "")[:2]
                read = kind == "layer" or kind == "media" and _holds(condition)
                read = read or kind == "supports" and not condition.startswith("not")
                blocks.append("@read" if read else "@passed")
            else:
                blocks.append(before)
                own = []
            continue
        if not inside.startswith("@"):
            own.append(before)
        if edge[0] == "}" and blocks and not blocks.pop().startswith("@"):
            _add_rule(inside, own, rules)
    if blocks and not blocks[-1].startswith("@"):  # a rule that the sheet ends in
        _add_rule(blocks[-1], [*own, sheet[at:]], rules)


def _add_rule(selectors: str, own: list[str], rules: Rules) -> None:
    said = _declared(";".join(own))
    for selector in selectors.split(",") if said else ():
        selector = selector.strip().lower()
        if SELECTOR.match(selector):
            known = rules.setdefault(selector, {})
            weight = (".#".find(selector[0]) + 1, rules.read)
            for name, (important, hides) in said.items():
                new = (important, *weight, hides)
                known[name] = max(known.get(name, new), new)
    rules.read += 1


def tree(html: str) -> tuple[Node, Rules]:
    """The root of the tree, and what style sheets say of simple selectors."""
    root = Node("#root", {})
    stack, open_names, rules = [root], Counter(), Rules()
    marks: list[int] = []  # depths of the open elements of MARKS

    def cut(depth: int) -> None:
        for node in stack[depth:]:
            open_names[node.name] -= 1
        del stack[depth:]
        while marks and marks[-1] >= depth:
            marks.pop()

    def in_table(back: int = 1) -> bool:
        return len(marks) >= back and stack[marks[-back]].name == "table"

    def add(child) -> None:
        """Append to the open element; directly in a table, before the table."""
        if isinstance(child, Node):
            strays = child.name not in INSIDE and child.name not in ("script", "style", "template", "form")
        else:
            strays = child.strip(" \t\n\f\r") != ""
        if strays and stack[-1].name in FOSTERS and in_table():
            # An open table is the last child of its parent.
            stack[marks[-1] - 1].children.insert(-1, child)
        else:
            stack[-1].children.append(child)

    def close(names, stops=()) -> None:
        """End the innermost open element of ``names``, unless one of ``stops`` is nearer."""
        if not any(open_names[n] for n in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                cut(depth)
                return
            if stack[depth].name in stops:
                return

    def start(name: str, given: dict[str, str]) -> None:
        for drawn, unshown in UNSHOWN.items():
            if name in unshown and open_names[drawn]:
                given = {**given, "hidden": ""}
        node = Node(name, given)
        if name == "table" and in_table():
            cut(marks[-1])
        elif name in INSIDE:
            if in_table(2) and stack[marks[-1]].name in (*CELLS, "caption"):
                cut(marks[-1])
            if in_table():
                depth = len(stack)
                while stack[depth - 1].name not in INSIDE[name]:
                    depth -= 1
                cut(depth)
                if name in CELLS and stack[-1].name != "tr":
                    start("tr", {})
        leaf = name in VOID or name == "form" and stack[-1].name in FOSTERS and in_table()
        add(node)
        if not leaf:
            if name in MARKS:
                marks.append(len(stack))
            stack.append(node)
            open_names[name] += 1

    for kind, name, extra in tokens(html):
        if kind == "text":
            add(unescape(name))
        elif kind == "raw":
            if extra == "style":
                if _holds(stack[-1].attributes.get("media", "").strip()):
                    _read_style(name, rules)
            stack[-1].children.append(unescape(name) if extra in ("textarea", "title") else name)
        elif kind == "start":
            if name in ("html", "body") and open_names[name]:
                continue
            if name in CLOSES_P:
                close(("p",), (*CELLS, "table", "button", "object", "caption"))
            if name in IMPLIED:
                names, stops = IMPLIED[name]
                if name in ("tr", *PARTS):
                    close(CELLS, ("table", "template"))
                if name in PARTS:
                    close(("tr",), ("table", "template"))
                close(names, stops)
            if name in CELLS and stack[-1].name in ("table", *PARTS):
                start("tr", {})
            start(name, attributes(extra) if extra.strip(" /\n\t") else {})
            if extra.endswith("/") and (open_names["svg"] or open_names["math"]) and name not in VOID:
                close((name,))  # in a drawing or a formula an element may end in its start tag
        elif name == "br":
            start("br", {})
        elif name == "p" and not open_names["p"]:
            start("p", {})
            close(("p",))
        else:
            close((name,), () if name in (*CELLS, "tr", *PARTS, "table", "template") else (*CELLS, "table"))
    return root, rules


def shown(node: Node, rules: Rules) -> bool:
    given = node.attributes
    if node.name in HIDDEN and not (node.name == "dialog" and "open" in given):
        return False
    if "hidden" in given:
        return False
    own = _declared(NO_STYLE.sub(" ", given["style"])) if "style" in given else {}
    if not rules:
        return not any(hides for _, hides in own.values())
    names = [node.name, *(f".{c.lower()}" for c in given.get("class", "").split())]
    names.append(f"#{given.get('id', '').lower()}")
    said = [rules[n] for n in names if n in rules]
    said.append({n: (important, 3, 0, hides) for n, (important, hides) in own.items()})
    return not any(max((r[n] for r in said if n in r), default=(False,))[-1] for n in HIDING)


class Page:
    """Lines so far, the line being written, and the empty line that is due before the next."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.indent, self.mark, self.gap, self.blank = 0, "", False, False
        self.tabled = False

    def text(self, text: str) -> None:
        """Inline text: white space runs are one blank, none at the start of a line."""
        text = BLANKS.sub(" ", text)
        if text.startswith(" ") and (not self.line or self.blank):
            text = text[1:]
        if text:
            self.line.append(text)
            self.blank = text.endswith(" ")

    def end_line(self, always: bool = False) -> None:
        line = "".join(self.line).rstrip(" ").replace("\xa0", " ")
        self.line, self.blank = [], False
        if line or always or self.mark:
            if not line and not always:
                return  # a mark waits for its text
            if self.gap and self.lines:
                self.lines.append("")
            pad = " " * max(0, self.indent - len(self.mark))
            self.lines.append((pad + self.mark + line).rstrip(" "))
            self.gap, self.mark = False, ""

    def space(self) -> None:
        self.end_line()
        self.gap = True


def _cells(table: Node, rules: Rules):
    """(lines, columns) of each visible cell, row by row. A cell that holds a table is one line.

    A generator like ``_rendered``.
    """
    rows: list[list[tuple[list[str], int]]] = []
    carried: dict[int, int] = {}  # column -> rows that a cell above still covers
    queue = [table]
    while queue:
        node = queue.pop()
        for child in reversed(node.children):
            if isinstance(child, Node) and child.name in ("tr", *PARTS) and shown(child, rules):
                if child.name != "tr":
                    queue.append(child)
                    continue
                queue.append(child)
        if node.name != "tr":
            continue
        row, column = [], 0
        for cell in node.children:
            if not (isinstance(cell, Node) and cell.name in CELLS and shown(cell, rules)):
                continue
            while carried.get(column, 0) > 0:
                carried[column] -= 1
                row.append(([], 1))
                column += 1
            across, down = _number(cell, "colspan", 100), _number(cell, "rowspan", 1000)
            text, tabled = yield cell
            lines = text.split("\n")
            if tabled:
                lines = [" ".join(lines).strip()]
            row.append((lines if text.strip() else [], across))
            for c in range(column, column + across):
                carried[c] = down - 1
            column += across
        rows.append(row)
    return rows


def _number(node: Node, name: str, most: int) -> int:
    digits = node.attributes.get(name, "1").strip()
    return min(max(int(digits), 1), most) if digits.isdecimal() and len(digits) < 9 else 1


def _table(page: Page, table: Node, rules: Rules):
    """Cells of a column under each other, columns two blanks apart; a cell keeps its lines."""
    page.space()
    page.tabled = True
    for child in table.children:
        if isinstance(child, Node) and child.name == "caption" and shown(child, rules):
            text, _ = yield child
            page.text(text.replace("\n", " "))
            page.end_line()
    rows = yield from _cells(table, rules)
    rows = [row for row in rows if any(lines for lines, _ in row)]
    widths: dict[int, int] = {}
    for row in rows:
        column = 0
        for lines, across in row:
            if across == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
            column += across
    for row in rows:
        for k in range(max(len(lines) for lines, _ in row)):
            column, out = 0, ""
            for lines, across in row:
                width = sum(widths.get(c, 0) for c in range(column, column + across)) + 2 * (across - 1)
                out += (lines[k] if k < len(lines) else "").ljust(width) + "  "
                column += across
            page.line = [out]
            page.end_line(always=True)
    page.gap = True


def render(root: Node, rules: Rules) -> str:
    """The visible text of a subtree. Parts that stand apart (cells, captions) are asked for by what
    they stand in, and wait on a stack of our own, so depth is no limit."""
    waiting, found = [_rendered(root, rules)], None
    while waiting:
        try:
            part = waiting[-1].send(found)
        except StopIteration as done:
            waiting.pop()
            found = done.value
        else:
            waiting.append(_rendered(part, rules))
            found = None
    return found[0]


def _rendered(root: Node, rules: Rules):
    """A generator: yields a cell or caption, is sent what is found in it, and returns the text of the
    whole and whether it holds a table."""
    page = Page()
    counters: list[list] = []  # of open lists: [next number or None]
    queue: list = [("open", root, False)]
    while queue:
        step, node, keep = queue.pop()
        if step == "close":
            name = node.name
            if name in ("ul", "ol", "menu"):
                counters.pop()
                page.indent -= 2
            if name == "dd" or name == "blockquote":
                page.end_line()
                page.indent -= 2
            if name == "li":
                page.end_line()
                page.mark = ""
            if name == "text":
                page.text(" ")
            if name in SPACED and not (counters and name in ("ul", "ol")):
                page.space()
            elif name in BLOCK:
                page.end_line()
            continue
        if not isinstance(node, Node):
            if keep:
                first, *more = node.replace("\r\n", "\n").split("\n")
                page.line.append(first)
                for line in more:
                    page.end_line(always=True)
                    page.line.append(line)
            else:
                page.text(node)
            continue
        name = node.name
        if node is not root and not shown(node, rules):
            continue
        if name == "br":
            page.end_line(always=True)
            continue
        if name == "table" and node is not root:
            yield from _table(page, node, rules)
            continue
        if name in CELLS and node is not root:
            page.text(" ")  # a cell outside any table
        if name == "text":
            page.text(" ")  # labels of a drawing stand apart
        if name in SPACED and not (counters and name in ("ul", "ol")):
            page.space()
        elif name in BLOCK:
            page.end_line()
        if name in ("ul", "ol", "menu"):
            first = _number(node, "start", 10**8) if name == "ol" else None
            counters.append([first])
            page.indent += 2
        elif name == "li":
            number = counters[-1][0] if counters else None
            page.mark = "- " if number is None else f"{number}. "
            if number is not None:
                counters[-1][0] = number + 1
        elif name in ("dd", "blockquote"):
            page.indent += 2
        elif name == "img" and node.attributes.get("alt"):
            page.text(node.attributes["alt"])
        elif name == "input" and node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
            page.text(f" {node.attributes.get('value', '')} ")
        queue.append(("close", node, keep))
        keep = keep or name in ("pre", "textarea", "xmp")
        closed = name == "details" and "open" not in node.attributes
        for child in reversed(node.children):
            if not closed or (isinstance(child, Node) and child.name == "summary"):
                queue.append(("open", child, keep))
    page.end_line()
    return "\n".join(page.lines).strip("\n"), page.tabled


def text_of(html: str | None) -> str:
    """Visible text of a page; null and empty pages have none."""
    return render(*tree(html)) if html else ""


def extract_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the visible text of column ``html`` in column ``text`` instead of it.

    Null and empty pages give empty text, broken ones what a lenient reader sees: unclosed elements
    end with the page, stray end tags are passed over, a tag that never ends shows nothing, nor does
    what follows it. Elements and tables may be nested to any depth. A column that is
    called ``text`` already is replaced. Rows are independent, one at a time; repeated rows give
    repeated results, an empty table an empty one.
    """
    others = [c for c in pages.columns if c not in (html, text)]
    source = free_name(pages, "__html")
    rows = pages.select(*[pages[c] for c in others], pages[html].alias(source))
    schema = rows.drop(source).withColumn(text, F.lit("")).schema

    def run(batches):
        for batch in batches:
            found = pa.array([text_of(h) for h in batch.column(source).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(others))], found], [*others, text]
            )

    return rows.mapInArrow(run, schema)
