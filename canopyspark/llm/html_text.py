"""Layout-aware text of HTML pages: a one-pass scanner, a tree builder with implied tags, visibility by attributes and inheritance, and
block, list and table layout. Everything takes time and memory in proportion to the page, however deep or broken it is."""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyspark.llm.shared import small_batches, table

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style head title template noscript iframe noembed noframes object svg math canvas audio video datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks with an empty line before and after.
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
#: Form controls with text of their own, shown on lines of their own.
CONTROL = frozenset("select optgroup option textarea".split())
#: Parts of a table that its rows and cells are looked for in, as in any other element that has some.
PARTS = frozenset("tbody thead tfoot tr td th caption colgroup".split())
#: Elements that the end tag of an inline element doesn't reach over.
SPECIAL = BLOCK | PARTS | HIDDEN | {"button", "select"}
#: Start tags that close an open p.
CLOSES_P = BLOCK - {"body", "html", "legend", "summary"}
#: Elements that end tags of inner elements don't reach over.
SCOPE = frozenset("table td th caption html template".split())
P_ENDS = ("p",), tuple(SCOPE | {"button"})
#: End tags that reach over them all the same.
TABLE_ENDS = frozenset("table tr tbody thead tfoot".split())
#: Start tag: open elements that it closes, and those that stop the search for them.
_ROW_ENDS = frozenset("tr td th caption colgroup".split())
IMPLIED_END = {
    "li": ({"li"}, SCOPE | {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, SCOPE | {"dl"}),
    "dd": ({"dt", "dd"}, SCOPE | {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "button": ({"button"}, SCOPE),
    "tr": (_ROW_ENDS, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (_ROW_ENDS | {"tbody", "thead", "tfoot"}, {"table"})),
    **dict.fromkeys(HEADING, (HEADING, SPECIAL - HEADING)),
}
#: What may stand in a head.
IN_HEAD = frozenset("meta title link base script style noscript template".split())
#: Lists nested deeper are indented as much as at this depth, so that a page's text grows with the page.
DEEPEST_INDENT = 32
#: A table's columns are aligned if that takes at most so many characters (or slots) for each of its texts' (or cells'); else a row's
#: cells are two spaces apart. When a page's tables, inner ones first, have taken so many characters for each of the page's, the others'
#: cells are blocks. So time and text stay in proportion to the page, and no text is lost.
ALIGNED_SHARE = 16
#: Limits of spans in HTML.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
_MARKUP = re.compile(r"<[a-zA-Z/!?]")
_NAME = re.compile(r"[^\s/>]+")
_ATTRIBUTE = re.compile(r"[\s/]*(?:(>)|(=?[^\s/>=]*)(?:\s*(=)\s*)?)")
_UNQUOTED = re.compile(r"[^\s>]*")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NUMBER = re.compile(r"\s*([+-]?\d{1,9})")


def scanned(page: str) -> Iterator[tuple]:
    """("text", words), ("start", name, attributes) and ("end", name) in order; comments and declarations are left out.

    Quotes count only right after =, and a quote that is never closed is an ordinary character. Contents of RAW elements are one text.
    A tag that the page's end cuts off is dropped.
    """
    at, size, never = 0, len(page), set()
    while at < size:
        m = _MARKUP.search(page, at)
        begin = m.start() if m else size
        if begin > at:
            yield "text", page[at:begin]
        if not m:
            return
        closing = m[0] == "</"
        if m[0] in ("<!", "<?") or closing and not (page[begin + 2 : begin + 3].isascii() and page[begin + 2 : begin + 3].isalpha()):
            comment = page.startswith("<!--", begin)
            end = page.find("-->" if comment else ">", begin + 2)
            at = size if end < 0 else end + (3 if comment else 1)
            continue
        name = _NAME.match(page, begin + 1 + closing)
        tag, at = name[0].lower(), name.end()
        attributes: dict[str, str] = {}
        if page.startswith(">", at):
            at += 1
        else:
            while True:
                m = _ATTRIBUTE.match(page, at)
                at = m.end()
                if m[1]:
                    break
                if at >= size:
                    return
                value = ""
                if m[3]:
                    quote = page[at]
                    close = page.find(quote, at + 1) if quote in "\"'" and quote not in never else -1
                    if quote in "\"'" and close < 0:
                        never.add(quote)
                    if close >= 0:
                        value, at = page[at + 1 : close], close + 1
                    else:
                        bare = _UNQUOTED.match(page, at)
                        value, at = bare[0], bare.end()
                if m[2]:
                    attributes.setdefault(m[2].lower(), value)
        if closing:
            yield "end", tag
            continue
        if tag in ("svg", "math") and page[at - 2] == "/":
            continue
        yield "start", tag, attributes
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at) if ("raw", tag) not in never else None
            if not end:
                never.add(("raw", tag))
            inside = page[at : end.start() if end else size]
            if inside:
                yield "text", inside.removeprefix("\n")
            at = size if not end else page.find(">", end.start()) + 1 or size
            yield "end", tag


class Node:
    __slots__ = ("attributes", "children", "tag", "veiled")

    def __init__(self, tag: str, attributes: dict[str, str], veiled: bool = False):
        self.tag, self.attributes, self.children, self.veiled = tag, attributes, [], veiled


def _style(attributes: dict[str, str]) -> dict[str, str]:
    """Declarations of a style attribute that say whether something is seen; the last of a name counts."""
    if "style" not in attributes:
        return {}
    parts = (d.partition(":") for d in html.unescape(attributes["style"]).lower().split(";"))
    return {k.strip(): v.replace("!important", "").strip() for k, _, v in parts if k.strip() in ("display", "visibility")}


class Open:
    """Open elements: a stack, and for each name the places of its elements in it, so that no search walks the stack."""

    def __init__(self, root: Node):
        self.stack, self.places, self.special = [root], {}, []

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in SPECIAL:
            self.special.append(len(self.stack))
        self.stack.append(node)

    def cut(self, place: int) -> None:
        """Ends the element at a place and all in it."""
        while len(self.stack) > place:
            node = self.stack.pop()
            self.places[node.tag].pop()
            if node.tag in SPECIAL:
                self.special.pop()

    def last(self, tags) -> int:
        """The place of the innermost of these elements; 0 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, wanted, stops) -> None:
        """Ends from the outermost wanted element inside the innermost stop."""
        stop = self.last(stops)
        inside = [p[k] for t in wanted if (p := self.places.get(t)) and (k := bisect_right(p, stop)) < len(p)]
        if inside:
            self.cut(min(inside))


def tree(page: str) -> Node:
    """The visible elements and texts of a page.

    Implied ends (p, li, dt, dd, options, headings, table parts) close; an end tag without a start is ignored; elements open at the end of
    the page end there. A head that is open ends at a body, at text and at elements of a body. Table rows need no tbody here, and cells
    outside a row get one. Elements that hidden, display:none or their kind take out aren't kept; visibility is inherited, and text that it
    hides isn't kept.
    """
    root = Node("html", {})
    held = Open(root)
    stack = held.stack
    for kind, *rest in scanned(page):
        top = stack[-1]
        if kind == "text":
            if top.tag == "head" and _SPACE.sub("", rest[0]):
                held.cut(len(stack) - 1)
                top = stack[-1]
            if not top.veiled:
                top.children.append(html.unescape(rest[0]))
            continue
        tag = rest[0]
        if kind == "end":
            _ended(held, tag)
            continue
        attributes = rest[1]
        if tag in ("html", "body"):
            if tag == "body":
                held.close({"head"}, {"template"})
            continue
        if tag in CLOSES_P:
            held.close(*P_ENDS)
        if tag in IMPLIED_END:
            held.close(*IMPLIED_END[tag])
        if tag in ("td", "th") and held.last(("tr",)) <= held.last(("td", "th", "table")):
            row = Node("tr", {}, stack[-1].veiled)
            stack[-1].children.append(row)
            held.push(row)
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            held.cut(len(stack) - 1)
        style, parent = _style(attributes), stack[-1]
        veiled = {"hidden": True, "collapse": True, "visible": False}.get(style.get("visibility"), parent.veiled)
        node = Node(tag, attributes, veiled)
        if not (tag in HIDDEN or "hidden" in attributes or style.get("display") == "none" or tag == "dialog" and "open" not in attributes):
            parent.children.append(node)
        if tag not in VOID:
            held.push(node)
    return root


def _ended(held: Open, tag: str) -> None:
    stack = held.stack
    if tag == "br" or tag == "p" and held.last(("p",)) <= held.last(SCOPE):
        stack[-1].children.append(Node(tag, {}))
        return
    if tag in ("html", "body"):
        return
    place = held.last(HEADING) if tag in HEADING else held.last((tag,))
    reach = held.last(SCOPE - {tag}) if tag in SPECIAL and tag not in TABLE_ENDS else 0
    if tag not in SPECIAL and held.special:
        reach = held.special[-1]
    if place and place > reach:
        held.cut(place)


class Lines:
    """Text under way: lines, the line that is being written, and how many line ends are due before the next character."""

    def __init__(self):
        self.done: list[str] = []
        self.now: list[str] = []
        self.due = 0
        self.space = False
        self.mark = ""

    def write(self, text: str, keep: bool = False) -> None:
        if keep:
            for k, line in enumerate(text.split("\n")):
                if k:
                    self.line_end()
                if line:
                    self._put(line)
            return
        if not text:
            return
        words = _SPACE.split(text)
        if words[0] == "" and len(words) > 1:
            self.space = True
        body = " ".join(w for w in words if w)
        if body:
            self._put(body)
            self.space = words[-1] == ""

    def _put(self, body: str) -> None:
        if self.due:
            self._flush()
            self.done += [""] * (self.due - 1 if self.done else 0)
            self.due = 0
        if self.mark:
            self.now.append(self.mark)
            self.mark = ""
        elif self.space and self.now and not self.now[-1].endswith((" ", "\t")):
            self.now.append(" ")
        self.space = False
        self.now.append(body)

    def _flush(self) -> None:
        if self.now:
            self.done.append("".join(self.now).rstrip(" "))
            self.now = []

    def line_end(self) -> None:
        if self.now:
            self._flush()
        else:
            self.done.append("")
        self.space = False

    def block(self, ends: int) -> None:
        """At least so many line ends before what follows."""
        self.space = False
        if self.now or self.done:
            self.due = max(self.due, ends)

    def text(self) -> list[str]:
        self._flush()
        return self.done


def _inline(node: Node) -> bool:
    return node.tag not in BLOCK and node.tag not in CONTROL and node.tag not in PARTS


def _number(node: Node, name: str, default: int, low: int, high: int) -> int:
    m = _NUMBER.match(node.attributes.get(name, ""))
    return min(max(int(m[1]), low), high) if m else default


def _holders(table: Node) -> set[int]:
    """Elements, by id, that parts of this table are in, but for those in its cells, captions and inner tables."""
    found, todo = set(), [(c, [id(table), None]) for c in table.children if isinstance(c, Node)]
    while todo:
        at, above = todo.pop()
        if at.tag in PARTS:
            up = above
            while up and up[0] not in found:
                found.add(up[0])
                up = up[1]
        if at.tag not in ("table", "td", "th", "caption"):
            own = [id(at), above]
            todo += [(c, own) for c in at.children if isinstance(c, Node)]
    return found


def _laid_out(node: Node, tables: dict[int, tuple]) -> tuple[list[str], list]:
    """Lines of a table, captions first, and all else that is visible in it, in order, which follows it. Rows and cells count through any
    element that isn't a table. A cell may have several lines; empty ones are left out."""
    rows, lines, loose = [], [], []
    holders = _holders(node)
    todo: list[tuple] = [(c, None) for c in reversed(node.children)]
    while todo:
        at, row = todo.pop()
        if isinstance(at, str):
            loose.append(at)
        elif at.tag in ("td", "th"):
            if row is None:
                rows.append(row := [])
            row.append((_number(at, "colspan", 1, 1, MOST_COLUMNS), _number(at, "rowspan", 1, 0, MOST_ROWS) or MOST_ROWS, [x for x in rendered(at, tables) if x]))
            loose.append(" ")
        elif at.tag == "caption":
            lines += rendered(at, tables)
        elif at.tag in PARTS or at.tag != "table" and id(at) in holders:
            if at.tag == "tr" and row is None:
                rows.append(row := [])
            todo += [(c, row) for c in (" ", *reversed(at.children), " ")]
        else:
            loose.append(at)
    return lines + aligned(rows), loose


def _placed(rows: list[list[tuple]]) -> list[list[tuple[int, int, list[str]]]] | None:
    """Each row's cells as (first column, column after the last, lines): a cell takes the next columns that no cell of a row above still
    spans. None if that takes more than ALIGNED_SHARE steps for each cell."""
    out, spans, steps = [], [], 0  # spans: (first, after, rows left), by first
    room = ALIGNED_SHARE * sum(len(r) + 1 for r in rows)
    for row in rows:
        column, k, placed, new = 0, 0, [], []
        for wide, tall, lines in row:
            while k < len(spans) and spans[k][0] < column + wide:
                column, k = max(column, spans[k][1]), k + 1
            placed.append((column, column + wide, lines))
            if tall > 1:
                new.append((column, column + wide, tall))
            column += wide
        out.append(placed)
        steps += len(spans) + len(row)
        if steps > room:
            return None
        spans = sorted([*spans, *new])
        spans = [(a, b, left - 1) for a, b, left in spans if left > 1]
    return out


def aligned(rows: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Rows of cells (columns, rows, lines) as lines: columns as wide as their widest cell, two spaces apart, a cell's further lines below
    its first. A cell that spans columns starts at its first one, and its text at its first row."""
    placed = _placed(rows)
    if placed is not None:
        starts = sorted({a for row in placed for a, _, _ in row})
        width = [0] * len(starts)
        cells = [(bisect_left(starts, a), bisect_left(starts, b), lines) for row in placed for a, b, lines in row]
        for first, after, lines in sorted(cells, key=lambda c: c[1] - c[0]):
            missing = max(map(len, lines), default=0) - (sum(width[first:after]) + 2 * (after - first - 1) if after - first < 64 else 0)
            if missing > 0 and after - first < 64:
                width[after - 1] += missing
        at = [0]
        for w in width:
            at.append(at[-1] + w + 2 * (w > 0))
        taken = sum(at[bisect_left(starts, row[-1][0])] * max((len(c[2]) for c in row), default=0) for row in placed if row)
        if taken <= ALIGNED_SHARE * (sum(len(x) + 2 for c in cells for x in c[2]) + 64):
            return [line for row in placed for line in _lines_of([(at[bisect_left(starts, a)], lines) for a, _, lines in row])]
    return [line for row in rows for line in _lines_of([(0, lines) for _, _, lines in row])]


def _lines_of(cells: list[tuple[int, list[str]]]) -> Iterator[str]:
    """Lines of a row whose cells start at these places, or two spaces behind what stands before."""
    for k in range(max((len(lines) for _, lines in cells), default=0)):
        parts, size = [], 0
        for start, lines in cells:
            if k < len(lines):
                gap = max(start - size, 2 if size else 0)
                parts += [" " * gap, lines[k]]
                size += gap + len(lines[k])
        yield "".join(parts)


def rendered(node: Node, tables: dict[int, tuple]) -> list[str]:
    """Lines of what a reader sees of a node, without recursion; tables: by id, what _laid_out gives for those in it."""
    out = Lines()
    pre = 0
    lists: list[list] = []
    todo: list = [("in", c) for c in reversed(node.children)]
    while todo:
        kind, x = todo.pop()
        if kind == "in" and isinstance(x, str):
            out.write(x, keep=pre > 0)
            continue
        spaced = 2 if x.tag in SPACED and not (lists and x.tag in ("ul", "ol", "p")) else 1
        if kind == "in":
            if x.tag == "br":
                out.line_end()
                continue
            if x.tag == "img":
                continue
            if id(x) in tables:
                lines, loose = tables[id(x)]
                out.block(2)
                for line in lines:
                    out.block(1)
                    out.write(line, keep=True)
                out.block(2)
                todo += [("in", c) for c in reversed(loose)]
                continue
            if not _inline(x):
                out.block(spaced)
            if x.tag in ("ul", "ol", "menu", "dir"):
                lists.append([x.tag, _number(x, "start", 1, -(10**9), 10**9) if x.tag == "ol" else 1])
            elif x.tag == "li":
                level = min(max(0, len(lists) - 1), DEEPEST_INDENT)
                ordered = lists and lists[-1][0] == "ol"
                if ordered:
                    lists[-1][1] = _number(x, "value", lists[-1][1], -(10**9), 10**9)
                out.mark = "  " * level + (f"{lists[-1][1]}. " if ordered else "- ")
                if lists:
                    lists[-1][1] += 1
            elif x.tag == "hr":
                continue
            pre += x.tag in ("pre", "textarea")
            todo.append(("out", x))
            todo += [("in", c) for c in reversed(x.children)]
            continue
        pre -= x.tag in ("pre", "textarea")
        if x.tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif x.tag == "li":
            out.mark = ""
        if not _inline(x):
            out.block(spaced)
    return out.text()


def _tables(root: Node) -> list[Node]:
    """All tables, outer ones before those in them."""
    found, todo = [], [root]
    while todo:
        at = todo.pop()
        if at.tag == "table":
            found.append(at)
        todo += [c for c in at.children if isinstance(c, Node)]
    return found


def visible_text(page: str | None) -> str:
    if not page:
        return ""
    root = tree(page)
    tables: dict[int, tuple] = {}
    room = ALIGNED_SHARE * len(page) + 10_000
    for node in reversed(_tables(root)):
        if room > 0:
            tables[id(node)] = _laid_out(node, tables)
            room -= sum(len(line) + 8 for line in tables[id(node)][0])
    return "\n".join(rendered(root, tables)).strip("\n")


def html_text(pages: DataFrame) -> DataFrame:
    """page_id and text (all visible text of html) of every row of pages.

    Null and empty pages give an empty text; a null page_id stays null; repeated rows are rendered one by one; an empty table gives an
    empty result; other columns are ignored. Markup is parsed whole, whatever its length and depth. Style sheets and scripts don't count;
    the contents of a closed details element do.
    """
    small_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([visible_text(x.as_py()) for x in batch.column(1)], pa.string())], ["page_id", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, text string")


def op7_html_extraction(spark, sf_dir: str) -> DataFrame:
    """All of pages."""
    return html_text(table(spark, sf_dir, "pages"))
