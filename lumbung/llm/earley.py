"""Weighted Earley parsing whose chart is read as a stream: each item keeps its cheapest derivation as cost and audit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property


@dataclass(frozen=True)
class Rule:
    """left -> right. A symbol with rules of its own is a nonterminal; others are terminals, which a token may match at a cost. An empty right side costs `cost` and adds `letter` to the audit."""

    left: str
    right: tuple[str, ...]
    cost: int = 0
    letter: str = ""


@dataclass(frozen=True)
class Grammar:
    start: str
    rules: tuple[Rule, ...]

    @cached_property
    def of(self) -> dict[str, list[Rule]]:
        found: dict[str, list[Rule]] = {}
        for rule in self.rules:
            found.setdefault(rule.left, []).append(rule)
        return found


class Audit:
    """A string as its last letter and what is before it, shared by all strings that begin the same. tag: what the letter does, carried along."""

    __slots__ = ("before", "depth", "letter", "tag")

    def __init__(self, before: Audit | None, letter: str, tag: str = "") -> None:
        self.before, self.letter, self.tag, self.depth = before, letter, tag, before.depth + 1 if before else 0


EMPTY = Audit(None, "")


def joined(left: Audit, right: Audit) -> Audit:
    """Both strings; the right one is short unless the left one is empty."""
    if left is EMPTY:
        return right
    nodes = []
    while right is not EMPTY:
        nodes.append(right)
        right = right.before
    for node in reversed(nodes):
        left = Audit(left, node.letter, node.tag)
    return left


def less(a: Audit, b: Audit) -> bool:
    """Whether a's string comes before b's: both are walked back to where they part."""
    shorter = a.depth < b.depth
    while a.depth > b.depth:
        a = a.before
    while b.depth > a.depth:
        b = b.before
    parted = None
    while a is not b:
        if a.letter != b.letter:
            parted = a.letter < b.letter
        a, b = a.before, b.before
    return shorter if parted is None else parted


class Chart:
    """The chart of a text that is given token by token. An item is a rule, a place in it and the position where it began; it keeps the least (cost, audit).

    match(terminal, token): cost, letter and tag of taking the token as the terminal, or None. slack: items that cost more than the cheapest by more than
    this go; the caller proves that none of them can win. Positions that no item began at are forgotten, and what all audits agree on is handed out by settled().
    """

    def __init__(self, grammar: Grammar, match: Callable[[str, object], tuple[int, str, str] | None], slack: int) -> None:
        self.grammar, self.match, self.slack, self.at, self.sets, self.root = grammar, match, slack, 0, {}, EMPTY
        self._close(0, {}, [grammar.start])

    def _close(self, at: int, items: dict, predicted: list[str]) -> None:
        """Completes and predicts at a position until nothing gets cheaper."""
        agenda = list(items)
        known: set[str] = set()

        def put(key: tuple, cost: int, audit: Audit) -> None:
            old = items.get(key)
            if old is None or cost < old[0] or (cost == old[0] and old[1] is not audit and less(audit, old[1])):
                items[key] = (cost, audit)
                agenda.append(key)

        def predict(symbol: str) -> None:
            if symbol not in known:
                known.add(symbol)
                for rule in self.grammar.of[symbol]:
                    if rule.right:
                        put((rule, 0, at), 0, EMPTY)
                    else:
                        put((rule, 0, at), rule.cost, Audit(EMPTY, rule.letter, rule.left) if rule.letter else EMPTY)

        self.sets[at] = items
        for symbol in predicted:
            predict(symbol)
        while agenda:
            key = agenda.pop()
            rule, dot, origin = key
            cost, audit = items[key]
            if dot < len(rule.right):
                symbol = rule.right[dot]
                if symbol in self.grammar.of:
                    predict(symbol)
                    for c, a in [v for k, v in items.items() if k[2] == at and k[1] == len(k[0].right) and k[0].left == symbol]:
                        put((rule, dot + 1, origin), cost + c, joined(audit, a))  # it ended where it began
            else:
                for (r, d, o), (c, a) in list(self.sets[origin].items()):
                    if d < len(r.right) and r.right[d] == rule.left:
                        put((r, d + 1, o), c + cost, joined(a, audit))

    def push(self, token: object) -> None:
        """Scans the next token."""
        items: dict = {}
        for (rule, dot, origin), (cost, audit) in self.sets[self.at].items():
            if dot < len(rule.right) and rule.right[dot] not in self.grammar.of and (found := self.match(rule.right[dot], token)):
                key, total, longer = (rule, dot + 1, origin), cost + found[0], Audit(audit, found[1], found[2])
                old = items.get(key)
                if old is None or total < old[0] or (total == old[0] and less(longer, old[1])):
                    items[key] = (total, longer)
        self.at += 1
        self._close(self.at, items, [])
        self._forget()

    def _forget(self) -> None:
        items = self.sets[self.at]
        best = min((cost for (_, _, origin), (cost, _) in items.items() if origin == 0), default=0)
        for key in [k for k, (cost, _) in items.items() if k[2] == 0 and cost > best + self.slack]:
            del items[key]
        live = {origin for _, _, origin in items} | {0, self.at}
        for position in [p for p in self.sets if p not in live]:
            del self.sets[position]

    def settled(self) -> list[Audit]:
        """Letters, in order, that all items now agree on and that were not handed out before."""
        ends = {id(audit): audit for (_, _, origin), (_, audit) in self.sets[self.at].items() if origin == 0 and self.at}.values()
        ends = [a for a in ends if a is not EMPTY]
        if not ends:
            return []
        common = ends[0]
        for other in ends[1:]:
            while common is not other:
                if common.depth >= other.depth:
                    common = common.before
                else:
                    other = other.before
        return self._until(common)

    def _until(self, last: Audit) -> list[Audit]:
        """Letters after those that were handed out, to `last`, behind which the string is cut."""
        found, node = [], last
        while node is not None and node is not self.root and node is not EMPTY:
            found.append(node)
            node = node.before
        if found:
            self.root = last
            last.before = None
        return found[::-1]

    def finish(self) -> tuple[int, list[Audit]] | None:
        """Cost of the cheapest parse of all tokens and the letters of its audit that were not handed out yet; None if there is none."""
        ends = [self.sets[self.at][k] for k in self.sets[self.at] if k[0].left == self.grammar.start and k[1] == len(k[0].right) and k[2] == 0]
        if not ends:
            return None
        best = ends[0]
        for other in ends[1:]:
            if other[0] < best[0] or (other[0] == best[0] and less(other[1], best[1])):
                best = other
        return best[0], self._until(best[1])
