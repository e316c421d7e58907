"""A small document tree and the selectors that site configurations use."""

from __future__ import annotations

import re
from html.entities import name2codepoint
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_FONT = ("tt", "i", "b", "u", "s", "strike", "big", "small")
# Which open elements a recovering HTML 4 parser ends when an element begins, as long as one of them is the innermost; elements of HTML 5 end none.
STARTS = {
    "form": {"form", "p", "hr", *_HEADINGS, "dl", "ul", "ol", "menu", "dir", "address", "pre", "head"}, "head": {"p"}, "title": {"p"}, "body": {"head", "style", "script", "title"},
    "li": {"p", *_HEADINGS, "dl", "address", "pre", "head", "li"}, "hr": {"p", "head"}, **{h: {"p", "head", *_HEADINGS} - {h} for h in _HEADINGS},
    "dir": {"p", "head"}, "address": {"p", "head", "ul"}, "pre": {"p", "head", "ul"}, "blockquote": {"p", "head"},
    "dl": {"p", "dt", "menu", "dir", "address", "pre", "head"}, "dt": {"p", "menu", "dir", "address", "pre", "head", "dd"}, "dd": {"p", "menu", "dir", "address", "pre", "head", "dt"},
    "ul": {"p", "head", "ol", "menu", "dir", "address", "pre"}, "ol": {"p", "head", "ul"}, "menu": {"p", "head", "ul"}, "p": {"p", "head", *_HEADINGS, *_FONT}, "div": {"p", "head"}, "noscript": {"script"},
    "center": {"font", "b", "i", "p", "head"}, "a": {"a", "head"}, "caption": {"p"}, "colgroup": {"caption", "colgroup", "col", "p"}, "col": {"caption", "col", "p"},
    "table": {"p", "head", *_HEADINGS, "pre", "a"}, **dict.fromkeys(("th", "td"), {"th", "td", "p", "span", "font", "a", "b", "i", "u"}), "tr": {"th", "td", "tr", "caption", "col", "colgroup", "p"},
    "thead": {"caption", "col", "colgroup"}, "tfoot": {"th", "td", "tr", "caption", "col", "colgroup", "thead", "tbody", "p"}, "tbody": {"th", "td", "tr", "caption", "col", "colgroup", "thead", "tfoot", "tbody", "p"},
    "optgroup": {"option"}, "option": {"option"}, "fieldset": {"legend", "p", "head", *_HEADINGS, "pre", "a"},
}
# Ranks of elements; an end tag does not reach past an open element of a higher rank than its own.
RANKS = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220}
_RANK = 100
REMOVED = frozenset("script style figure aside iframe nav noscript".split())


class Element:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None) -> None:
        self.tag, self.attributes, self.children = tag, attributes or {}, []

    def walk(self):  # noqa: ANN201
        """This element's descendants in document order."""
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            yield node
            if isinstance(node, Element):
                stack.extend(reversed(node.children))

    def text(self) -> str:
        return "".join(x for x in self.walk() if isinstance(x, str))

    def remove(self, tags: frozenset[str]) -> None:
        """Takes elements out of the tree, for good."""
        todo = [self]
        while todo:
            node = todo.pop()
            node.children = [c for c in node.children if isinstance(c, str) or c.tag not in tags]
            todo += [c for c in node.children if isinstance(c, Element)]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("[document]")
        self.stack = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ends = STARTS.get(tag, ())
        while self.stack[-1].tag in ends:
            self.stack.pop()
        node = Element(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.stack[-1].children.append(Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        """Ends the innermost open element of this tag, with all in it; nothing if there is none, or one of a higher rank is within it."""
        rank = RANKS.get(tag, _RANK)
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            if RANKS.get(self.stack[i].tag, _RANK) > rank:
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].children.append(data)


#: An ampersand before what is no character reference to that parser: a name that HTML 4 lacks, or one without its semicolon.
_PLAIN = re.compile(rf"&(?=[A-Za-z])(?!(?:{'|'.join([*name2codepoint, 'apos'])});)")


def parse(html: str) -> Element:
    """The tree of a page. References by name are read as HTML 4 has them, with their semicolon: others, as that of a text that was cut within one, stay as they are written."""
    mark = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in html)  # stands for those ampersands until the texts are there
    builder = _Builder()
    builder.feed(_PLAIN.sub(mark, html))
    builder.close()
    todo = [builder.root]
    while todo:
        node = todo.pop()
        node.attributes = {k: v.replace(mark, "&") for k, v in node.attributes.items()}
        node.children = [c.replace(mark, "&") if isinstance(c, str) else c for c in node.children]
        todo += [c for c in node.children if isinstance(c, Element)]
    return builder.root


_SIMPLE = re.compile(r"^([a-zA-Z][\w-]*)?(?:\.([\w-]+))?(?:#([\w-]+))?(?:\[([\w-]+)\*=['\"]([^'\"]*)['\"]\])?$")


def _test(selector: str):  # noqa: ANN202
    m = _SIMPLE.match(selector)
    if not m:
        raise ValueError(f"selector {selector!r} is not supported")
    tag, class_, id_, name, part = m.groups()

    def holds(e: Element) -> bool:
        return (
            (tag is None or e.tag == tag.lower())
            and (class_ is None or class_ in e.attributes.get("class", "").split())
            and (id_ is None or e.attributes.get("id") == id_)
            and (name is None or part in e.attributes.get(name, ""))
        )

    return holds


def select_one(root: Element, selector: str) -> Element | None:
    """The first element for tag, .class, tag.class, #id, [name*='part'] or several of these, each within the one before."""
    tests = [_test(s) for s in selector.split()]
    stack: list[tuple[Element, int]] = [(c, 0) for c in reversed(root.children) if isinstance(c, Element)]
    while stack:
        node, depth = stack.pop()
        if tests[depth](node):
            if depth == len(tests) - 1:
                return node
            depth += 1
        stack.extend((c, depth) for c in reversed(node.children) if isinstance(c, Element))
    return None


def find_all(root: Element, tag: str) -> list[Element]:
    return [e for e in root.walk() if isinstance(e, Element) and e.tag == tag]


def find_meta(root: Element, value: str) -> Element | None:
    """The first meta element with this property, else with this itemprop."""
    metas = find_all(root, "meta")
    return next((m for name in ("property", "itemprop") for m in metas if m.attributes.get(name) == value), None)
