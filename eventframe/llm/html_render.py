"""HTML to text by layout: a forgiving tree builder, visibility rules, then block, list and table rendering."""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that open a block of their own and so end an open paragraph.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks set off by an empty line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure hr fieldset".split())
#: Start tag -> open elements that it ends, and the elements that this search doesn't leave.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
FENCE = frozenset("table td th caption button object html".split())
#: What browsers don't show, or show something else in place of; svg holds text of its own, see visit.
HIDDEN = frozenset("head script style template noscript title iframe noembed noframes audio video canvas datalist rp annotation annotation-xml".split())
SVG_TEXT = frozenset("text foreignobject".split())
#: Elements nested deeper than this become siblings, as in browsers, whose trees are no deeper either.
DEPTH = 512
#: Largest colspan and rowspan, by the standard.
COLSPAN, ROWSPAN = 1000, 65_534
#: A table may have so many spaces for alignment for each character of its text; wider cells are left out of column widths until it does.
PADDING = 64

TAG = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>|!--|[!?/])", re.S)
ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
DISPLAY = re.compile(r"(?:^|[;{\s])display\s*:\s*([\w-]+)", re.I)
VISIBILITY = re.compile(r"(?:^|[;{\s])visibility\s*:\s*([\w-]+)", re.I)
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
#: A rule of a style sheet; blocks of other at-rules are left out, with what they hold.
RULE = re.compile(r"([^{}]*)\{([^{}]*)\}")
SELECTOR = re.compile(r"([A-Za-z][\w-]*|\*)?((?:[.#][\w-]+)*)")
BLANKS = re.compile(r"[ \t\r\n\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "gone")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children, self.gone = tag, attrs, [], False


def attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in ATTR.findall(source):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def parse(source: str) -> Node:
    """The element tree. Unclosed elements end where the document or an enclosing element does; stray end tags are dropped."""
    root = Node("html", {})
    stack, open_tags = [root], Counter({"html": 1})

    def pop_to(k: int) -> None:
        for node in stack[k:]:
            open_tags[node.tag] -= 1
        del stack[k:]

    def text(s: str) -> None:
        if s:
            stack[-1].children.append(html.unescape(s) if "&" in s else s)

    at, n = 0, len(source)
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            text(source[at:])
            break
        m = TAG.match(source, lt)
        if m is None:
            # a '<' that opens no tag, or a tag whose quote never ends
            if lt + 1 < n and (source[lt + 1].isalpha() or source[lt + 1] == "/" and source[lt + 2 : lt + 3].isalpha()):
                text(source[at:lt])
                end = source.find(">", lt)
                if end < 0:
                    break
                m = re.match(r"<(/?)([A-Za-z][^\s/>]*)(.*?)(/?)>", source[lt : end + 1], re.S)
                end += 1
            else:
                text(source[at : lt + 1])
                at = lt + 1
                continue
        else:
            text(source[at:lt])
            end = m.end()
        if m[0] == "<!--":
            stop = source.find("-->", lt + 4)
            at = n if stop < 0 else stop + 3
            continue
        if m.lastindex is None or not m[2]:
            stop = source.find(">", lt)
            at = n if stop < 0 else stop + 1
            continue
        at, tag = end, m[2].lower()
        if m[1]:
            if tag == "p" and not open_tags["p"]:
                stack[-1].children.append(Node("p", {}))
            elif tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif open_tags[tag] and tag != "html":
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        pop_to(k)
                        break
                    if stack[k].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body"):
                        break  # an end tag inside a cell doesn't end what holds the cell
            continue
        if tag == "html":
            continue
        if tag in BLOCK and open_tags["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    pop_to(k)
                    break
                if stack[k].tag in FENCE:
                    break
        if tag in IMPLIED:
            ends, fence = IMPLIED[tag]
            k = len(stack) - 1
            top = None
            while k > 0 and stack[k].tag not in fence and (stack[k].tag != "table"):
                if stack[k].tag in ends:
                    top = k
                k -= 1
            if top is not None:
                pop_to(top)
        node = Node(tag, attributes(m[3]) if m[3].strip() else {})
        stack[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            body = source[at : stop.start() if stop else n]
            if body:
                node.children.append(html.unescape(body) if tag in ("textarea", "title") else body)
            close = source.find(">", stop.end()) if stop else -1
            at = n if close < 0 else close + 1
        elif tag not in VOID and not (m[4] and tag not in BLOCK) and len(stack) < DEPTH:
            stack.append(node)
            open_tags[tag] += 1
    return root


def hidden(node: Node) -> bool:
    """Whether nothing of the node is shown; settle has looked at styles."""
    a = node.attrs
    return (
        node.gone
        or node.tag in HIDDEN
        or "hidden" in a
        or (node.tag == "input" and a.get("type", "").lower() in ("hidden", "checkbox", "radio", "password", "file", "image"))
        or (node.tag == "dialog" and "open" not in a)
    )


def at_rules_out(sheet: str) -> str:
    """The style sheet without at-rules, whose blocks hold for some media or hold no selectors."""
    out, at = [], 0
    while (k := sheet.find("@", at)) >= 0:
        out.append(sheet[at:k])
        brace, semicolon = sheet.find("{", k), sheet.find(";", k)
        if brace < 0 or 0 <= semicolon < brace:
            at = len(sheet) if semicolon < 0 else semicolon + 1
            continue
        depth, at = 1, brace + 1
        while depth and at < len(sheet):
            depth += {"{": 1, "}": -1}.get(sheet[at], 0)
            at += 1
    return "".join([*out, sheet[at:]])


class Styles:
    """Rules about display and visibility with simple selectors: an element, classes and an id; the more specific and, among
    equals, the later one holds. Selectors with combinators, attributes or states say nothing here."""

    def __init__(self, sheets: list[str]):
        self.rules: dict[str, list[tuple]] = {}
        order = 0
        for sheet in sheets:
            for selectors, body in RULE.findall(at_rules_out(COMMENT.sub("", sheet))):
                display, visibility = ([x.lower() for x in p.findall(body)] for p in (DISPLAY, VISIBILITY))
                for selector in selectors.split(",") if display or visibility else ():
                    m = SELECTOR.fullmatch(selector.strip())
                    if not m or not m[0]:
                        continue
                    tag, marks = (m[1] or "*").lower(), re.findall(r"[.#][\w-]+", m[2])
                    order += 1
                    weight = (sum(x[0] == "#" for x in marks), sum(x[0] == "." for x in marks), tag != "*", order)
                    self.rules.setdefault(marks[0] if marks else tag, []).append((weight, tag, frozenset(marks), display[-1:], visibility[-1:]))

    def of(self, node: Node) -> tuple[str, str]:
        """(display, visibility) of an element, as far as sheets and its own style say."""
        marks = {f".{c}" for c in node.attrs.get("class", "").split()} | ({f"#{node.attrs['id']}"} if "id" in node.attrs else set())
        found = sorted(r for key in (node.tag, "*", *marks) if key in self.rules for r in self.rules[key] if r[1] in ("*", node.tag) and r[2] <= marks) if self.rules else []
        display, visibility = "", ""
        for _, _, _, d, v in found:
            display, visibility = (d or [display])[0], (v or [visibility])[0]
        own = node.attrs.get("style", "")
        if own:
            display = [display, *DISPLAY.findall(own)][-1].lower()
            visibility = [visibility, *VISIBILITY.findall(own)][-1].lower()
        return display, visibility


def settle(root: Node, source: str) -> None:
    """Marks what styles take away. display:none takes all inside; visibility is inherited, and an element inside may be visible again."""
    low = source.lower()
    if "display" not in low and "visibility" not in low:
        return
    sheets, stack = [], [root]
    while stack:
        x = stack.pop()
        if x.tag == "style":
            sheets.append("".join(c for c in x.children if isinstance(c, str)))
        stack += [c for c in reversed(x.children) if isinstance(c, Node)]
    styles = Styles(sheets)
    todo: list[tuple[Node, bool, bool]] = [(root, True, False)]
    while todo:
        x, visible, done = todo.pop()
        if done:
            inside = any(isinstance(c, Node) and not c.gone for c in x.children)
            x.children = [c for c in x.children if isinstance(c, Node)]
            x.gone = not inside
            continue
        display, visibility = styles.of(x)
        if display == "none":
            x.gone = True
            continue
        visible = {"hidden": False, "collapse": False, "visible": True, "initial": True}.get(visibility, visible)
        if not visible:
            todo.append((x, False, True))
        todo += [(c, visible, False) for c in x.children if isinstance(c, Node)]


class Flow:
    """Lines of one block; text is collapsed as in a browser, and gaps between blocks merge."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.buf: list[str] = []
        self.gap = 0
        self.tight = False  # in a list item, where an inner list has no margin

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            self.buf.append(first)
            for x in rest:
                self.flush(True)
                self.buf.append(x)
        else:
            self.buf.append(BLANKS.sub(" ", s))

    def flush(self, force: bool = False, pre: bool = False) -> None:
        line = "".join(self.buf)
        if not (force or pre):
            line = re.sub(" {2,}", " ", line)
        self.buf = []
        if force or pre:
            line = line.rstrip()
        else:
            line = line.strip(" ")
        if line or force:
            self.add([line])

    def add(self, lines: list[str]) -> None:
        if self.lines and self.gap > 1:
            self.lines.extend([""] * (self.gap - 1))
        self.gap = 1
        self.lines.extend(lines)

    def block(self, gap: int, pre: bool = False) -> None:
        self.flush(pre=pre)
        self.gap = max(self.gap, gap)


def render_list(node: Node, flow: Flow) -> None:
    ordered, step = node.tag == "ol", -1 if "reversed" in node.attrs else 1
    try:
        number = int(node.attrs["start"])
    except (KeyError, ValueError):
        number = 1 if step > 0 else sum(isinstance(c, Node) and c.tag == "li" and not hidden(c) for c in node.children)
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li":
            if hidden(child):
                continue
            inner = lines_of(child, False, tight=True)
            if ordered and re.fullmatch("-?[0-9]{1,9}", child.attrs.get("value", "")):
                number = int(child.attrs["value"])
            mark = f"{number}. " if ordered else "- "
            number += step
            if inner:
                flow.add([mark + inner[0], *((" " * len(mark) + x if x else "") for x in inner[1:])])
        elif isinstance(child, Node):
            if child.tag in ("ul", "ol"):  # a list put straight into a list
                inner = Flow()
                visit(child, inner, False)
                inner.flush()
                if inner.lines:
                    flow.add(["  " + x if x else "" for x in inner.lines])
            else:
                visit(child, flow, False)
                flow.flush()
        else:
            flow.text(child, False)
            flow.flush()


def rows_of(table: Node) -> list[tuple[Node, Node]]:
    """(group, row) of the rows of a table in order; a cell without a row is one."""
    out: list[tuple[Node, Node]] = []
    stack = [(table, c) for c in reversed(table.children)]
    while stack:
        group, child = stack.pop()
        if not isinstance(child, Node) or hidden(child):
            continue
        if child.tag == "tr":
            out.append((group, child))
        elif child.tag in ("tbody", "thead", "tfoot"):
            stack += [(child, c) for c in reversed(child.children)]
        elif child.tag in ("td", "th"):
            row = Node("tr", {})
            row.children = [child]
            out.append((group, row))
    return out


def span_of(cell: Node, name: str, most: int) -> int:
    """A span as the standard reads it: leading digits, 1 where there are none, 0 as it is, and at most so many."""
    m = re.match(r"\s*\+?([0-9]+)", cell.attrs.get(name, ""))
    return min(most, int(m[1][:9])) if m else 1


def cells_of(node: Node) -> list[list[tuple[int, int, list[str]]]]:
    """(column, columns, lines) of the cells of each row that holds text; cells of rows above keep their columns."""
    grid, taken, last = [], {}, None
    for group, row in rows_of(node):
        if group is not last:  # no cell reaches beyond its group of rows
            taken, last = {}, group
        cells, column, below = [], 0, {}
        for cell in row.children:
            wide = tall = 1
            if isinstance(cell, str):
                inner = [x] if (x := BLANKS.sub(" ", cell).strip(" ")) else []
                if not inner:
                    continue
            elif hidden(cell):
                continue
            else:
                wide, tall = max(1, span_of(cell, "colspan", COLSPAN)), span_of(cell, "rowspan", ROWSPAN) or ROWSPAN
                inner = lines_of(cell, False)
            while column in taken:
                column += 1
            cells.append((column, wide, inner))
            if tall > 1:
                below |= dict.fromkeys(range(column, column + wide), tall)
            column += wide
        taken = {c: left - 1 for c, left in (taken | below).items() if left > 1}
        if any(c[2] for c in cells):
            grid.append(cells)
    return grid


def starts_of(grid: list[list[tuple[int, int, list[str]]]], limit: int) -> dict[int, int]:
    """Where each column in use starts, by the widest cell of each column that is no wider than limit."""
    width: dict[int, int] = {}
    for cells in grid:
        for column, span, inner in cells:
            width[column] = max([width.get(column, 0), *(len(x) for x in inner if span == 1 and len(x) <= limit)])
    starts, at = {}, 0
    for column in sorted(width):
        starts[column] = at
        at += width[column] + 2
    return starts


def render_table(node: Node, flow: Flow) -> None:
    for child in node.children:  # what a table holds beside its rows comes before it, as browsers place it
        if isinstance(child, str) or child.tag not in ("tbody", "thead", "tfoot", "tr", "td", "th", "colgroup", "col"):
            if isinstance(child, str):
                flow.text(child, False)
            else:
                visit(child, flow, False)
    flow.flush()
    grid = cells_of(node)
    held = [(cells, k) for cells in grid for k in range(max(len(c[2]) for c in cells))]
    text = sum(len(x) for cells in grid for c in cells for x in c[2])
    limit = max([0, *(len(x) for cells in grid for c in cells for x in c[2])])
    while True:  # spaces are at most the place where the last cell of each line starts
        starts = starts_of(grid, limit)
        if sum(max([0, *(starts[c] for c, _, inner in cells if k < len(inner) and inner[k])]) for cells, k in held) <= PADDING * (text + 64) or not limit:
            break
        limit //= 2
    for cells, k in held:
        line: list[str] = []
        length = 0
        for column, _, inner in cells:
            if k < len(inner) and inner[k]:
                at = max(starts[column], length + 2 if length else 0)
                line += [" " * (at - length), inner[k]]
                length = at + len(inner[k])
        flow.add(["".join(line).rstrip()])


def svg_texts(node: Node) -> list[Node]:
    """What of a drawing is text."""
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if x.tag in SVG_TEXT:
            out.append(x)
        else:
            stack += [c for c in reversed(x.children) if isinstance(c, Node) and not hidden(c) and c.tag not in ("desc", "metadata", "defs", "symbol")]
    return out


def visit(node: Node, flow: Flow, pre: bool) -> None:
    if hidden(node):
        return
    tag = node.tag
    if tag == "br":
        flow.flush(force=True) if flow.buf else flow.add([""]) if flow.lines else None
        return
    if tag == "input":
        flow.text(node.attrs.get("value", ""), False)
        return
    if tag == "svg":
        for x in svg_texts(node):
            flow.text(" ", False)
            for child in x.children:
                flow.text(child, False) if isinstance(child, str) else visit(child, flow, False)
            flow.text(" ", False)
        return
    pre = pre or tag in ("pre", "textarea", "xmp")
    is_block = tag in BLOCK
    gap = 1 if tag not in SPACED or flow.tight and tag in ("ul", "ol", "menu", "dir") else 2
    if is_block:
        flow.block(gap, pre)
    if tag in ("ul", "ol", "menu", "dir"):
        inner = Flow()
        render_list(node, inner)
        if inner.lines:
            flow.add(inner.lines)
    elif tag == "table":
        inner = Flow()
        render_table(node, inner)
        if inner.lines:
            flow.add(inner.lines)
    elif tag == "dd" or tag == "blockquote":
        inner = lines_of(node, pre)
        if inner:
            flow.add(["  " + x if x else "" for x in inner])
    else:
        closed = tag == "details" and "open" not in node.attrs
        for k, child in enumerate(node.children):
            if isinstance(child, str):
                if not closed:  # a newline right after <pre> is no text
                    flow.text(child.removeprefix("\n") if tag == "pre" and not k else child, pre)
            elif not closed or child.tag == "summary":
                visit(child, flow, pre)
    if is_block:
        flow.block(gap, pre)


def lines_of(node: Node, pre: bool, tight: bool = False) -> list[str]:
    """The lines of a node's content, without empty ones at its ends."""
    flow = Flow()
    flow.tight = tight
    for k, child in enumerate(node.children):
        if isinstance(child, str):
            flow.text(child.removeprefix("\n") if node.tag == "pre" and not k else child, pre)
        else:
            visit(child, flow, pre)
    flow.flush(pre=pre)
    lines = flow.lines
    while lines and not lines[-1]:
        lines.pop()
    k = 0
    while k < len(lines) and not lines[k]:
        k += 1
    return lines[k:]


def find_title(node: Node) -> str | None:
    stack = [node]
    while stack:
        x = stack.pop()
        if x.tag == "svg":
            continue
        if x.tag == "title":
            return BLANKS.sub(" ", "".join(c for c in x.children if isinstance(c, str))).strip()
        stack += [c for c in reversed(x.children) if isinstance(c, Node)]
    return None


def render(source: str) -> tuple[str | None, str]:
    """(title, visible text)."""
    if sys.getrecursionlimit() < 8 * DEPTH:
        sys.setrecursionlimit(8 * DEPTH)
    root = parse(source)
    settle(root, source)
    return find_title(root), "\n".join(lines_of(root, False))


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per row of pages: id_col, title (null if there is none), text.

    text holds all that a browser would show: no head, scripts, styles, templates or elements hidden by attribute, inline
    style or a rule of a style sheet with a simple selector; formulas, the text of drawings and what stands in for objects are shown. Blocks start
    lines, paragraphs, headings, lists and tables are set off by an empty line, list items carry their mark and indentation, cells
    of a column start at the same place, cells of rows above keep theirs. Where that took more than 64 spaces for each character
    of a table, its widest cells move those after them instead. A null or empty page has a null title and an empty text. Elements
    nested deeper than 512 become siblings at that depth, as in browsers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [render(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in made], pa.string()), pa.array([b for _, b in made], pa.string())], ["id", "title", "text"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, title string, text string").select(F.col("id").alias(id_col), "title", "text")
