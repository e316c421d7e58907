"""What a page's style sheets say of its elements: display, visibility, white-space and list-style, by selectors, specificity and order.

Selectors are compounds of tags, classes, ids, attributes (with all their operators), :is(), :where(), :not(), :root, :empty and the :first-, :last-, :only- and :nth-child family, within, directly within, next to
or after what is before. Rules may be nested. Other pseudo-classes depend on what a reader does: rules with one say nothing of a page that is only read, and inside :not() they hold.
Media rules are those of a screen of WIDTH pixels with a mouse, in landscape and light colours; what asks for anything else that is not known here does not hold, so it
can't hide a text. Conditions on containers and scopes can't be told either and don't hold.
"""

from __future__ import annotations

import re

#: The screen that media rules are for.
WIDTH, HEIGHT = 1280, 800
#: Parts of a selector that are read; longer ones are left out.
LONGEST = 40
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_PROPERTIES = ("display", "visibility", "white-space", "list-style", "list-style-type")
_DECLARED = re.compile(r"(?:^|[;{])\s*(display|visibility|white-space|list-style(?:-type)?)\s*:\s*([^;{}!]*?)\s*(!\s*important\s*)?(?=;|\}|\Z)", re.I)
_MEDIA_KNOWN = {"orientation": "landscape", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "prefers-contrast": "no-preference", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "scripting": "none", "update": "fast"}
_LENGTH = re.compile(r"([\d.]+)\s*(px|em|rem)?\Z")
_RANGE = re.compile(r"(?:([\d.]+\s*(?:px|em|rem)?)\s*(<=?|>=?|=)\s*)?(width|height)(?:\s*(<=?|>=?|=)\s*([\d.]+\s*(?:px|em|rem)?))?\Z")
_IDENT = re.compile(r"(?:\\.|[\w-]|[^\x00-\x7f])+")
_ATTRIBUTE = re.compile(r"\[\s*([\w:-]+)\s*(?:([~|^$*]?=)\s*(\"[^\"]*\"|'[^']*'|[^\s\]]+)\s*([iIsS])?\s*)?\]")
_NTH = re.compile(r"(?:(odd|even)|([+-]?\d*)n\s*(?:([+-])\s*(\d+))?|([+-]?\d+))\Z")
_MARKERS = frozenset("none disc circle square decimal decimal-leading-zero lower-alpha lower-latin upper-alpha upper-latin lower-roman upper-roman".split())


def declared(block: str) -> list[tuple[str, str, bool]]:
    """(property, value, important) in order; list-style counts as what it says of list-style-type."""
    found = []
    for m in _DECLARED.finditer(block):
        name, value = m[1].lower(), m[2].lower().strip()
        if name == "list-style":
            name, value = "list-style-type", next((v for v in value.split() if v in _MARKERS), "disc" if value else "")
        if value:
            found.append((name, value, bool(m[3])))
    return found


def _pixels(text: str) -> float | None:
    m = _LENGTH.match(text.strip())
    try:
        return float(m[1]) * (1 if m[2] in (None, "px") else 16) if m else None
    except ValueError:
        return None


def _feature(text: str) -> bool | None:
    """Whether a media feature holds; None if that can't be told."""
    name, colon, value = (x.strip() for x in text.partition(":"))
    if not colon:
        if m := _RANGE.match(name):
            mine, holds = WIDTH if m[3] == "width" else HEIGHT, True
            for limit, sign, left in ((m[1], m[2], True), (m[5], m[4], False)):
                if limit is not None:
                    bound = _pixels(limit)
                    if bound is None:
                        return None
                    a, b = (bound, mine) if left else (mine, bound)
                    holds = holds and {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b, "=": a == b}[sign]
            return holds
        return True if name in ("color", "hover", "any-hover", "pointer", "any-pointer") else None
    side, _, what = name.rpartition("-")
    if what in ("width", "height") and side in ("min", "max", ""):
        mine, bound = WIDTH if what == "width" else HEIGHT, _pixels(value)
        return None if bound is None else mine >= bound if side == "min" else mine <= bound if side == "max" else mine == bound
    return _MEDIA_KNOWN[name] == value if name in _MEDIA_KNOWN else None


def for_screen(query: str) -> bool:
    """Whether any of a media rule's queries holds for the screen."""
    return not query.strip() or any(_holds(q) for q in _split(query.lower(), ","))


def _holds(query: str) -> bool:
    parts = query.split(None, 1)
    negated = parts[:1] == ["not"]
    rest = parts[1] if negated and len(parts) > 1 else query
    rest = re.sub(r"^\s*only\s+", "", rest).strip()
    if " or " in rest:
        found = [_condition(x) for x in re.split(r"\s+or\s+", rest)]
        value = True if True in found else None if None in found else False
    else:
        found = [_condition(x) for x in re.split(r"\s+and\s+", rest)]
        value = False if False in found else None if None in found else True
    return value is not None and value != negated


def _condition(text: str) -> bool | None:
    text = text.strip()
    if text[:4] == "not ":
        inner = _condition(text[4:])
        return None if inner is None else not inner
    if text[:1] == "(":
        return _feature(text[1:-1] if text[-1:] == ")" else text[1:])
    return text in ("screen", "all") if re.fullmatch(r"[a-z-]+", text) else None


def _split(text: str, sign: str) -> list[str]:
    """Parts of a text between signs that are not in brackets or quotes."""
    parts, depth, quote, begin = [], 0, "", 0
    for i, c in enumerate(text):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth = max(0, depth - 1)
        elif c == sign and not depth:
            parts.append(text[begin:i])
            begin = i + 1
    return [*parts, text[begin:]]


def blocks(sheet: str) -> list[tuple[list[str], str]]:
    """(selectors from the outermost rule to the innermost, declarations) of a sheet's rules, those within conditions that hold included."""
    sheet, found, at = _COMMENT.sub(" ", sheet), [], 0
    open_: list[tuple[str | None, bool]] = []  # of the open braces: the selector, if it is a rule, and whether what is in it is left out
    for m in re.finditer(r"[{};]", sheet):
        if m.start() < at:
            continue
        head = sheet[at : m.start()].strip()
        at = m.end()
        skipping = bool(open_ and open_[-1][1])
        if m[0] == "{":
            name = head[:1] == "@" and re.split(r"[\s(]", head[1:], maxsplit=1)[0].lower()
            if name:
                holds = for_screen(head[6:]) if name == "media" else not re.match(r"\s*not\b", head[9:], re.I) if name == "supports" else name == "layer"
                open_.append((None, skipping or not holds))
            else:
                open_.append((head, skipping))
        else:
            if head and not skipping and any(s is not None for s, _ in open_):
                found.append(([s for s, _ in open_ if s is not None], head))
            if m[0] == "}" and open_:
                open_.pop()
    rest = sheet[at:].strip()
    if rest and open_ and not open_[-1][1] and any(s is not None for s, _ in open_):
        found.append(([s for s, _ in open_ if s is not None], rest))
    return found


class Compound:
    """One element's part of a selector. Raises ValueError for what is not read."""

    def __init__(self, text: str) -> None:
        self.tag, self.ids, self.classes, self.attributes, self.tests, self.never = "", [], [], [], [], False
        self.weight = [0, 0, 0]
        at = 0
        if (m := _IDENT.match(text)) or text[:1] == "*":
            self.tag, at = (m[0].lower(), m.end()) if m else ("", 1)
            self.weight[2] += bool(self.tag)
        while at < len(text):
            sign = text[at]
            if sign in ".#" and (m := _IDENT.match(text, at + 1)):
                (self.classes if sign == "." else self.ids).append(re.sub(r"\\(.)", r"\1", m[0]))
                self.weight[int(sign == ".")] += 1
                at = m.end()
            elif sign == "[" and (m := _ATTRIBUTE.match(text, at)):
                value = m[3][1:-1] if m[3] and m[3][0] in "\"'" else m[3]
                self.attributes.append((m[1].lower(), m[2], value, (m[4] or "").lower() == "i"))
                self.weight[1] += 1
                at = m.end()
            elif sign == ":" and (m := re.compile(r":(:?)([\w-]+)(\()?").match(text, at)):
                end = m.end()
                if m[3]:
                    end = _closing(text, m.end() - 1)
                self._pseudo(m[2].lower(), text[m.end() : end - 1] if m[3] else "", bool(m[1]))
                at = end
            else:
                raise ValueError(text)

    def _pseudo(self, name: str, inside: str, element: bool) -> None:
        if element or name in ("before", "after", "first-line", "first-letter"):
            self.never = True  # what it makes is not an element of the page
        elif name in ("is", "where", "not", "matches", "any", "-webkit-any"):
            chains = [c for s in _split(inside, ",") if (c := chain(s, strict=name == "not"))]
            self.tests.append(("not" if name == "not" else "is", chains))
            if name != "where":
                heaviest = max((weight(c) for c in chains), default=(0, 0, 0))
                self.weight = [a + b for a, b in zip(self.weight, heaviest, strict=True)]
        elif name in ("root", "empty", "first-child", "last-child", "only-child", "first-of-type", "last-of-type", "only-of-type", "nth-child", "nth-last-child", "nth-of-type", "nth-last-of-type"):
            step = _nth(inside) if name.startswith("nth") else None
            if name.startswith("nth") and step is None:
                raise ValueError(name)
            self.tests.append((name, step))
            self.weight[1] += 1
        elif name in ("link", "any-link"):
            self.attributes.append(("href", None, None, False))
        elif name in ("enabled", "read-only", "defined"):
            self.weight[1] += 1
        else:
            self.never = True
            self.weight[1] += 1

    def key(self) -> str:
        """What an element must have to be worth a look."""
        return "#" + self.ids[0] if self.ids else "." + self.classes[0] if self.classes else self.tag

    def plain(self, node) -> bool:  # noqa: ANN001
        """Whether the element itself fits, without its surroundings."""
        if self.never or (self.tag and node.tag != self.tag):
            return False
        if self.ids and any(node.get("id") != i for i in self.ids):
            return False
        if self.classes and not set(self.classes) <= set((node.get("class") or "").split()):
            return False
        return all(_has(node.get(name), sign, value, fold) for name, sign, value, fold in self.attributes)


def _has(have: str | None, sign: str | None, value: str | None, fold: bool) -> bool:
    if have is None or sign is None:
        return have is not None
    if fold:
        have, value = have.lower(), value.lower()
    if sign == "=":
        return have == value
    if sign == "~=":
        return value in have.split()
    if sign == "|=":
        return have == value or have.startswith(value + "-")
    return bool(value) and (have.startswith(value) if sign == "^=" else have.endswith(value) if sign == "$=" else value in have)


def _closing(text: str, at: int) -> int:
    """The place after the bracket that closes the one at a place."""
    depth = 0
    for i in range(at, len(text)):
        depth += (text[i] == "(") - (text[i] == ")")
        if not depth:
            return i + 1
    raise ValueError(text)


def _nth(text: str) -> tuple[int, int] | None:
    """Step and start of an+b."""
    m = _NTH.match(text.strip().lower())
    if not m:
        return None
    if m[1]:
        return 2, int(m[1] == "odd")
    if m[5] is not None:
        return 0, int(m[5])
    step = int(m[2] + "1") if m[2] in ("", "+", "-") else int(m[2])
    return step, int((m[3] or "+") + (m[4] or "0"))


Chain = list[tuple[str, Compound]]


def chain(selector: str, *, strict: bool = False) -> Chain:
    """The parts of a selector with what is between each and the one before: "" within, ">" directly within, "+" next to, "~" after. Empty if it isn't read; strict: then it raises."""
    parts, sign, at = [], "", 0
    text = selector.strip()
    try:
        while at < len(text):
            if text[at] in " \t\n\r\f>+~":
                if text[at] in ">+~":
                    sign = text[at]
                at += 1
                continue
            end, depth, quote = at, 0, ""
            while end < len(text) and (depth or quote or text[end] not in " \t\n\r\f>+~"):
                c = text[end]
                if quote:
                    quote = "" if c == quote else quote
                elif c in "\"'":
                    quote = c
                else:
                    depth += (c in "([") - (c in ")]")
                end += 1
            parts.append((sign if parts else "", Compound(text[at:end])))
            sign, at = "", end
        if len(parts) > LONGEST:
            raise ValueError(selector)
    except ValueError:
        if strict:
            raise
        return []
    return parts


def weight(parts: Chain) -> tuple[int, int, int]:
    return tuple(sum(c.weight[i] for _, c in parts) for i in range(3))


def nested(levels: list[str]) -> list[str]:
    """The selectors that rules within rules stand for: & is the outer one, and where it is not named the inner one is within it."""
    outer = [s.strip() for s in _split(levels[0], ",")]
    for level in levels[1:]:
        around = outer[0] if len(outer) == 1 else f":is({', '.join(outer)})"
        outer = [s.replace("&", around) if "&" in s else f"{around} {s.strip()}" for s in _split(level, ",")]
    return outer


class Page:
    """Whether elements of one page fit chains; what was found out is kept, so that each question is answered once for each element."""

    def __init__(self) -> None:
        self.here: dict[tuple, bool] = {}
        self.above: dict[tuple, bool] = {}
        self.earlier: dict[tuple, list] = {}
        self.places: dict[int, tuple[list, dict]] = {}

    def siblings(self, parent) -> tuple[list, dict]:  # noqa: ANN001
        """The elements directly within another, and their places."""
        known = self.places.get(id(parent))
        if known is None:
            elements = [c for c in parent.children if not isinstance(c, str)]
            known = self.places[id(parent)] = (elements, {id(c): i for i, c in enumerate(elements)})
        return known

    def fits(self, parts: Chain, i: int, node, path: list, depth: int) -> bool:  # noqa: ANN001
        """Whether the parts up to i fit an element, whose ancestors are path[:depth], outermost first."""
        key = (id(parts), i, id(node))
        found = self.here.get(key)
        if found is None:
            found = self.here[key] = self._fits(parts, i, node, path, depth)
        return found

    def _fits(self, parts: Chain, i: int, node, path: list, depth: int) -> bool:  # noqa: ANN001
        sign, compound = parts[i]
        if not compound.plain(node) or not all(self._test(*t, node, path, depth) for t in compound.tests):
            return False
        if i == 0:
            return True
        if not depth:
            return False
        if sign == ">":
            return self.fits(parts, i - 1, path[depth - 1], path, depth - 1)
        if sign == "":
            return self._within(parts, i - 1, path, depth)
        elements, places = self.siblings(path[depth - 1])
        place = places.get(id(node), 0)
        if sign == "+":
            return place > 0 and self.fits(parts, i - 1, elements[place - 1], path, depth)
        first = self.earlier.setdefault((id(parts), i - 1, id(path[depth - 1])), [0, None])  # how far was looked, and the first that fits
        while first[1] is None and first[0] < place:
            if self.fits(parts, i - 1, elements[first[0]], path, depth):
                first[1] = first[0]
            first[0] += 1
        return first[1] is not None and first[1] < place

    def _within(self, parts: Chain, i: int, path: list, depth: int) -> bool:
        """Whether any of path[:depth] fits: looked up at the innermost that was asked before, then told to those within it."""
        top = depth
        while top and (id(parts), i, id(path[top - 1])) not in self.above:
            top -= 1
        found = bool(top) and self.above[id(parts), i, id(path[top - 1])]
        for k in range(top, depth):
            found = found or self.fits(parts, i, path[k], path, k)
            self.above[id(parts), i, id(path[k])] = found
        return found

    def _test(self, name: str, value, node, path: list, depth: int) -> bool:  # noqa: ANN001
        if name in ("is", "not"):
            return (name == "is") == any(self.fits(c, len(c) - 1, node, path, depth) for c in value)
        if name == "root":
            return not depth
        if name == "empty":
            return not node.children
        if not depth:
            return True  # the root has no siblings
        elements, places = self.siblings(path[depth - 1])
        if name.endswith("of-type"):
            elements = [e for e in elements if e.tag == node.tag]
            place = next(i for i, e in enumerate(elements) if e is node)
        else:
            place = places[id(node)]
        before, after = place + 1, len(elements) - place
        if name.startswith("only"):
            return len(elements) == 1
        step, start = value if value is not None else (0, 1)
        n = after if "last" in name else before
        return n == start if step == 0 else (n - start) % step == 0 and (n - start) // step >= 0


class Sheets:
    """Rules of all sheets of a page, by what their last part asks for. sheets: (media, text) of each."""

    def __init__(self, sheets: list[tuple[str, str]]) -> None:
        self.by: dict[str, list[tuple[Chain, tuple, list]]] = {}
        self.page, order = Page(), 0
        for media, sheet in sheets:
            if not any(p in sheet.lower() for p in _PROPERTIES) or not for_screen(media):
                continue
            for levels, block in blocks(sheet):
                declarations = declared(block)
                if not declarations:
                    continue
                for selector in nested(levels):
                    parts = chain(selector)
                    order += 1
                    if parts and not parts[-1][1].never:
                        self.by.setdefault(parts[-1][1].key(), []).append((parts, (*weight(parts), order), declarations))

    def values(self, node, path: list) -> dict[str, str]:  # noqa: ANN001
        """Properties as the sheets and the element's own style give them; the important and heavier, then the later, count."""
        best: dict[str, tuple[tuple, str]] = {}

        def put(declarations: list[tuple[str, str, bool]], heavy: tuple) -> None:
            for i, (name, value, important) in enumerate(declarations):
                key = (important, *heavy, i)
                if name not in best or best[name][0] <= key:
                    best[name] = (key, value)

        if self.by:
            keys = ["", node.tag]
            if node.attributes:
                keys += ["." + c for c in set((node.get("class") or "").split())] + (["#" + i] if (i := node.get("id")) else [])
            for key in keys:
                for parts, heavy, declarations in self.by.get(key, ()):
                    if self.page.fits(parts, len(parts) - 1, node, path, len(path)):
                        put(declarations, (0, *heavy))
        if node.attributes and (style := node.get("style")):
            put(declared(style), (1, 0, 0, 0, 0))
        return {name: value for name, (_, value) in best.items()}
