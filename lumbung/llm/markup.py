"""Layout-aware rendering of HTML to text: everything that a reader would see, with the page's blocks, lists and tables.

A tree is built with the tags that HTML implies (a block ends a paragraph, a list item the one before, a cell the cell before, a stray end tag ends
nothing). Elements that are not shown are left out: heads, scripts, templates, closed details and dialogs, options that aren't chosen, and what the hidden attribute, inline styles
and the page's style sheets hide (styles.py). What is visible within something invisible is shown.
Text of pictures (svg) and formulas (math) is shown; what stands in for an object, a film or a script that doesn't run is not.
The rest is laid out, by tag or as display, white-space and list-style say: white space collapses within a block, blocks begin on new lines with blank lines where
browsers leave a margin, list items get bullets or numbers and are indented, and the cells of a table are padded to columns.

Everything runs on stacks of its own, and what is open is found by tag, so nesting of any depth and attributes of any length are read in time that grows
with the page. Lists, quotations and tables that are nested more than DEEPEST deep are plain blocks: their text is shown, without more indentation.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .styles import Sheets

# Elements by how HTML treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes title meta link base object audio video canvas datalist annotation annotation-xml".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr fieldset".split())
BLOCK = MARGIN | frozenset("html body div section article aside nav header footer main address li dt dd form details summary figcaption caption tr td th thead tbody tfoot legend center dialog menu dir hgroup search option optgroup".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
HEAD = frozenset("title meta link base style script template noscript".split())
#: A start tag of the first ends open elements of the second, up to an element of the third.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
#: End tags don't reach past these.
SCOPE = frozenset("table td th caption html template".split())

#: Lists, quotations, cells and tables within each other that are laid out as such.
DEEPEST = 100

_TAG = re.compile(r"<!--|<!\[CDATA\[|<[!?]|</?([a-zA-Z][^\s/>]*+)")
_STEP = re.compile(r"[^>=]*+(?:>|=\s*+([\"'])?|\Z)")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_LAID_OUT = ("li", "dd", "blockquote", "td", "th", "table", "caption")


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str) -> str | None:
        """An attribute's value, "" if it has none, None if it isn't there."""
        if name not in self.attributes.lower():
            return None
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return html.unescape(m[2] or m[3] or m[4] or "")
        return None


class Open:
    """The elements that are open, and where those of each tag are."""

    def __init__(self, root: Node) -> None:
        self.stack, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, at: int) -> None:
        """Ends all elements from a place on."""
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()

    def last(self, tags) -> int:  # noqa: ANN001
        """The place of the innermost element of some tags; 0 if none is open."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def close(self, tags: set[str], until: set[str]) -> None:
        """Ends the innermost element of some tags, and the ones of these tags around it, unless one of until is further in."""
        while (at := self.last(tags)) and at > self.last(until):
            self.cut(at)
            if self.stack[-1].tag not in tags:
                break


def _tag_end(source: str, at: int, closing: dict[str, int]) -> int:
    """Where a start tag ends, after its ">"; quoted values may hold any. closing: for each quote, a place from which it is known not to come again."""
    while True:
        m = _STEP.match(source, at)
        at = m.end()
        if m[0].endswith(">") or at >= len(source):
            return at
        if m[1]:
            end = -1 if at >= closing[m[1]] else source.find(m[1], at)
            if end < 0:
                closing[m[1]] = min(closing[m[1]], at)
            else:
                at = end + 1


def parse(source: str) -> tuple[Node, list[tuple[str, str]]]:
    """The tree of a page, and its style sheets with the media that each is for."""
    root, styles = Node("html"), []
    open_ = Open(root)
    stack = open_.stack
    closing = {"'": len(source) + 1, '"': len(source) + 1}
    at, end = 0, len(source)

    def text(value: str) -> None:
        if value and not (stack[-1].tag in ("head", "table", "tr", "tbody", "thead", "tfoot", "colgroup") and not value.strip()):
            if stack[-1].tag == "head":
                open_.cut(len(stack) - 1)
            stack[-1].children.append(html.unescape(value) if "&" in value else value)

    while at < end:
        m = _TAG.search(source, at)
        if m is None:
            text(source[at:])
            break
        text(source[at : m.start()])
        at = m.end()
        tag = (m[1] or "").lower()
        if not tag:
            if m[0] == "<!--":
                stop = _COMMENT_END.search(source, at)
                at = at + 1 if source.startswith(">", at) else at + 2 if source.startswith("->", at) else stop.end() if stop else end
            elif m[0] == "<![CDATA[":
                stop = source.find("]]>", at)
                text(source[at : stop if stop >= 0 else end])
                at = stop + 3 if stop >= 0 else end
            else:
                at = source.find(">", at) + 1 or end
            continue
        begin, at = at, _tag_end(source, at, closing)
        attributes = source[begin : at - 1] if source[at - 1] == ">" else source[begin:at]
        if m[0][1] == "/":
            if tag == "br":
                stack[-1].children.append(Node("br"))
            if tag in ("html", "body", "br"):
                continue
            where = open_.last(_HEADINGS if tag in _HEADINGS else (tag,))
            if where and (tag in ("table", "tr", "td", "th", "tbody", "thead", "tfoot") or stack[where].tag in SCOPE or where > open_.last(SCOPE)):
                open_.cut(where)
            elif not where and tag == "p":
                stack[-1].children.append(Node("p"))
            continue
        if tag in ("html", "body"):
            if tag == "body" and stack[-1].tag == "head":
                open_.cut(len(stack) - 1)
            if attributes:
                root.attributes += " " + attributes
            continue
        if stack[-1].tag == "head" and tag not in HEAD:
            open_.cut(len(stack) - 1)
        if tag in ENDS_P:
            open_.close({"p"}, SCOPE | {"button"})
            if tag in _HEADINGS and stack[-1].tag in _HEADINGS:
                open_.cut(len(stack) - 1)
        if tag in IMPLIED_ENDS:
            open_.close(*IMPLIED_ENDS[tag])
            if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                row = Node("tr")
                stack[-1].children.append(row)
                open_.push(row)
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in RAW:
            close_tag = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            stop = close_tag.start() if close_tag else end
            content = source[at:stop]
            if tag == "style":
                styles.append((node.get("media") or "", content))
            node.children.append(html.unescape(content) if tag in ("textarea", "title") else content)
            at = source.find(">", stop) + 1 if close_tag else end
            at = at or end
        elif tag not in VOID and (tag in BLOCK or not attributes.endswith("/")):
            open_.push(node)
    return root, styles


#: What an element's text is laid out by, as it inherits it: visibility, how white space is kept, and the marks of list items, if they are named.
State = tuple[bool, str, str]
_KEEPS = {"pre": "pre", "pre-wrap": "pre", "break-spaces": "pre", "pre-line": "lines", "normal": "", "nowrap": "", "initial": ""}
_INLINE = frozenset("inline inline-block inline-flex inline-grid inline-table contents ruby".split())
_TYPES = {"a": "lower-alpha", "A": "upper-alpha", "i": "lower-roman", "I": "upper-roman", "1": "decimal"}


def _styled(node: Node, path: list[Node], sheets: Sheets, state: State) -> tuple[str, State] | None:
    """How an element is displayed ("" as its tag is) and what its text is laid out by; None if it has no place on the page."""
    if node.tag in UNSEEN:
        return None
    values = sheets.values(node, path) if sheets.by or node.attributes else {}
    away = bool(node.attributes and node.get("hidden") is not None) or (node.tag == "dialog" and node.get("open") is None)
    display = values.get("display", "none" if away else "")
    if display == "none":
        return None
    seen, white, marks = state
    if (visibility := values.get("visibility")) not in (None, "inherit", "unset"):
        seen = visibility not in ("hidden", "collapse")
    white = _KEEPS.get(values.get("white-space", "pre" if node.tag in ("pre", "textarea") else ""), white) if node.tag in ("pre", "textarea") or "white-space" in values else white
    if node.tag in ("ul", "ol", "menu", "dir"):
        marks = _TYPES.get(node.get("type") or "", "") if node.tag == "ol" and node.attributes else ""
    named = values.get("list-style-type")
    return display, (seen, white, marks if named in (None, "inherit") else named)


def _roman(n: int) -> str:
    out = ""
    for value, letters in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split(), strict=True):
        out += letters * (n // value)
        n %= value
    return out


def mark(kind: str, number: int | None) -> str:
    """What stands before a list item: of an unordered list (no number) a dash, of others the number as the list counts."""
    if kind == "none":
        return ""
    if kind in ("disc", "circle", "square") or (number is None and not kind):
        return "- "
    number = 1 if number is None else number
    text = str(number)
    if kind == "decimal-leading-zero" and 0 <= number < 10:
        text = f"0{number}"
    elif kind.endswith(("alpha", "latin")) and number > 0:
        text, rest = "", number
        while rest:
            rest, digit = divmod(rest - 1, 26)
            text = chr(97 + digit) + text
    elif kind.endswith("roman") and 0 < number < 4000:
        text = _roman(number)
    return (text.upper() if kind.startswith("upper") else text) + ". "


def _chosen(node: Node) -> list[Node]:
    """The options of a select that are seen: all of a list box, else the chosen one, which is the first if none is."""
    options, stack = [], list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, Node):
            if c.tag == "option":
                options.append(c)
            elif c.tag == "optgroup":
                stack.extend(reversed(c.children))
    if node.get("multiple") is not None or _number(node.get("size"), 0, 10**6, 0) > 1:
        return options
    return [o for o in options if o.get("selected") is not None][-1:] or options[:1]


class Lines:
    """Lines of a block and its inline text so far."""

    __slots__ = ("inline", "lines", "margin", "space")

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.space = False
        self.margin = 0

    def text(self, value: str) -> None:
        parts = _SPACE.sub(" ", value)
        if parts[:1] == " ":
            self.space = True
            parts = parts[1:]
        if not parts:
            return
        if self.space and self.inline:
            self.inline.append(" ")
        self.space = parts[-1] == " "
        self.inline.append(parts[:-1] if self.space else parts)

    def end(self) -> None:
        """Ends the line, if there is one."""
        if self.inline:
            self.put(["".join(self.inline)])
            self.inline = []
        self.space = False

    def put(self, lines: list[str]) -> None:
        if lines:
            if self.lines:
                self.lines += [""] * self.margin
            self.margin = 0
            self.lines += lines

    def block(self, margin: int) -> None:
        self.end()
        self.margin = max(self.margin, margin)


def _table(rows: list[tuple[int, list[tuple[list[str], int, int]]]]) -> list[str]:
    """Rows of cells (lines, columns, rows) with their columns aligned. Each row has the number of its group, which cells of several rows don't leave; those of 0 rows go to its end."""
    last = {group: r for r, (group, _) in enumerate(rows)}
    grid: list[dict[int, list[str]]] = []
    reaching: list[tuple[int, int, int]] = []  # first and next column of cells from rows above, and the last row of each
    widths: dict[int, int] = {}
    for r, (group, row) in enumerate(rows):
        reaching = sorted(x for x in reaching if x[2] >= r)
        placed, column, at, more = {}, 0, 0, []
        for lines, wide, high in row:
            while at < len(reaching) and reaching[at][0] <= column:
                column, at = max(column, reaching[at][1]), at + 1
            placed[column] = lines
            widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
            end = last[group] if high == 0 else min(last[group], r + high - 1)
            if end > r:
                more.append((column, column + wide, end))
            column += wide
        reaching += more
        grid.append(placed)
    shown = sorted(i for i, w in widths.items() if w)
    out = []
    for placed in grid:
        for k in range(max(map(len, placed.values()), default=0)):
            out.append("  ".join((placed[i][k] if i in placed and k < len(placed[i]) else "").ljust(widths[i]) for i in shown).rstrip())
    return out


def _number(value: str | None, least: int, most: int, default: int) -> int:
    return min(most, max(least, int(value))) if value and value.strip().isascii() and value.strip().lstrip("-").isdigit() and len(value) < 9 else default


def _displayed(tag: str, display: str) -> tuple[bool, bool]:
    """Whether an element is a block, and whether it is laid out as its tag is, as a list item, a cell and so on."""
    if display in _INLINE:
        return False, False
    if display in ("block", "flex", "grid", "flow-root"):
        return True, tag in ("dd", "blockquote")
    return tag in BLOCK or display in ("table", "list-item", "table-row", "table-caption"), tag in _LAID_OUT


def render(source: str | None) -> str:
    """Visible text of a page; "" for null and empty ones."""
    if not source:
        return ""
    root, styles = parse(source)
    sheets = Sheets(styles)
    out = [Lines()]
    lists: list[list] = []  # open lists: number of the next item, or None, and how it goes on
    tables: list[list] = []  # open tables: rows of cells, captions, and the number of the row group
    path: list[Node] = []  # open elements
    drawn = 0  # open svg elements, less the parts of them that hold text
    stack: list[tuple] = [(root, None, (True, "", ""))]
    while stack:
        node, leave, state = stack.pop()
        if isinstance(node, str):
            if not state[0] or drawn:
                continue
            if state[1]:
                for i, line in enumerate(node.split("\n")):
                    if i:
                        out[-1].put(["".join(out[-1].inline)])
                        out[-1].inline, out[-1].space = [], False
                    if state[1] == "lines":
                        out[-1].text(line)
                    elif line:
                        out[-1].inline.append(line)
            else:
                out[-1].text(node)
            continue
        tag, now = node.tag, out[-1]
        if leave is None:
            if tag == "br":
                now.put(["".join(now.inline)])
                now.inline, now.space = [], False
                continue
            found = _styled(node, path, sheets, state)
            if found is None:
                continue
            display, state = found
            seen = state[0]
            if tag == "hr":
                now.block(1)
                now.put(["---"] if seen else [])
                now.block(1)
                continue
            if tag == "img":
                if seen and (alt := node.get("alt")):
                    now.text(alt)
                continue
            if tag == "input":
                if seen and (node.get("type") or "text").lower() not in ("hidden", "checkbox", "radio", "file", "image", "password") and (value := node.get("value")):
                    now.text(value)
                continue
            if tag in VOID:
                continue
            block, laid = _displayed(tag, display)
            if block:
                now.block(0 if tag in ("ul", "ol") and lists else int(tag in MARGIN))
            laid = laid and len(out) <= DEEPEST
            kept = drawn
            if tag == "svg" or tag in ("text", "foreignobject"):
                drawn = int(tag == "svg")
            stack.append((node, (block, laid, kept), state))
            path.append(node)
            children = node.children
            if tag in ("ul", "menu", "dir"):
                lists.append([None, 0])
            elif tag == "ol":
                backward = node.get("reversed") is not None
                items = sum(isinstance(c, Node) and c.tag == "li" for c in children) if backward else 1
                lists.append([_number(node.get("start"), -(10**6), 10**6, items), -1 if backward else 1])
            elif tag == "table" and laid:
                tables.append([[], [], 0])
            elif tag in ("thead", "tbody", "tfoot") and tables:
                tables[-1][2] += 1
            elif tag == "tr" and tables:
                tables[-1][0].append((tables[-1][2], []))
            if laid:
                out.append(Lines())
            if tag == "details" and node.get("open") is None:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            elif tag == "select":
                children = _chosen(node)
            if tag in ("pre", "textarea") and children and isinstance(children[0], str):
                children = [children[0].removeprefix("\n"), *children[1:]]
            stack.extend((c, None, state) for c in reversed(children))
            continue
        path.pop()
        block, laid, drawn = leave
        if block:
            now.end()
        if laid:
            lines, outer = out.pop(), out[-1]
            lines.end()
            lines = lines.lines
            if tag == "li":
                number = lists[-1][0] if lists else None
                if number is not None:
                    number = _number(node.get("value"), -(10**6), 10**6, number)
                    lists[-1][0] = number + lists[-1][1]
                before = mark(state[2], number)
                outer.put([(before if not i else " " * len(before)) + x if x else "" for i, x in enumerate(lines)])
            elif tag in ("dd", "blockquote"):
                outer.put([("    " if tag == "dd" else "> ") + x if x else "" for x in lines])
            elif tag in ("td", "th") and tables and tables[-1][0]:
                tables[-1][0][-1][1].append((lines, _number(node.get("colspan"), 1, 1000, 1) or 1, _number(node.get("rowspan"), 0, 65534, 1)))
            elif tag == "caption" and tables:
                tables[-1][1] += lines
            elif tag == "table" and tables:
                rows, caption, _ = tables.pop()
                outer.put(caption + lines + _table(rows))
            else:
                outer.put(lines)
        if tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif tag in ("thead", "tbody", "tfoot") and tables:
            tables[-1][2] += 1
        if block:
            out[-1].block(0 if tag in ("ul", "ol") and lists else int(tag in MARGIN))
    out[0].end()
    return "\n".join(line.rstrip() for line in out[0].lines).strip("\n")


def extract(pages: DataFrame, key: str = "page_id", source: str = "html") -> DataFrame:
    """key, text and n_lines for each row of pages; other columns are not read.

    Pages of any length are read whole. Null and empty pages have an empty text and no lines. Rows are on their own: repeated and null keys do not matter, equal pages give equal texts; an
    empty table gives no rows. Broken markup gives what can be read of it.
    """

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([render(x) for x in b], dtype="object")

    rows = pages.select(key, text(source).alias("text"))
    return rows.withColumn("n_lines", F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long"))
