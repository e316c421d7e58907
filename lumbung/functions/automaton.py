"""Keywords of large lexicons in texts: an automaton in arrays that goes through many texts at once.

The automaton is that of Aho and Corasick with its failures resolved: a table of the next state by state and character, built level by level. Texts are cut into pieces that overlap by the longest
keyword, and all pieces take a step together, so a step is a few array operations however many keywords there are. A match is a whole word, in any case, as
text.word_pattern() has it; matches of different keywords may overlap, those of one keyword don't.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import numpy as np

#: Bytes that an automaton's table may take: it is sent to every worker. Characters of a piece.
TABLE_BYTES, PIECE = 512 << 20, 2048
_KNOWN = 0x20000


@cache
def _small() -> np.ndarray:
    """The small letter of each character, where that is one character."""
    table = np.arange(_KNOWN, dtype=np.uint32)
    for i in range(_KNOWN):
        low = chr(i).lower()
        if len(low) == 1 and low != chr(i):
            table[i] = ord(low)
    table[0x17F] = ord("s")
    return table


@cache
def _words() -> np.ndarray:
    """Whether each character is a letter, a digit or an underscore."""
    return np.array([chr(i).isalnum() or i == 0x5F for i in range(_KNOWN)])


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def lowered(points: np.ndarray) -> np.ndarray:
    return np.where(points < _KNOWN, _small()[np.minimum(points, _KNOWN - 1)], points)


class Automaton:
    """Finds keywords, given by their number."""

    def __init__(self, keywords: Sequence[str]) -> None:
        words = [lowered(_points(k)) for k in keywords]
        if any(not len(w) for w in words):
            raise ValueError("a keyword is empty")
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.longest = int(self.lengths.max(initial=1))
        self.alphabet = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint32)
        width = len(self.alphabet) + 1
        children: list[dict[int, int]] = [{}]
        parents, by_level, ends = [0], [[0]], []
        for word in words:
            state = 0
            for depth, c in enumerate((np.searchsorted(self.alphabet, word) + 1).tolist(), 1):
                after = children[state].get(c)
                if after is None:
                    after = children[state][c] = len(children)
                    children.append({})
                    parents.append(state)
                    if len(by_level) == depth:
                        by_level.append([])
                    by_level[depth].append(after)
                state = after
            ends.append(state)
        if len(children) * width * 4 > TABLE_BYTES:
            raise ValueError(f"a table of {len(children)} states by {width} characters is more than {TABLE_BYTES} bytes: part the lexicon")
        self.next = np.zeros((len(children), width), np.int32)
        fail = np.zeros(len(children), np.int64)
        own: list[list[int]] = [[] for _ in children]
        for k, state in enumerate(ends):
            own[state].append(k)
        for level in by_level:
            at = np.array(level, np.int64)
            self.next[at] = self.next[fail[at]] if level != [0] else 0
            for state in level:
                if state:
                    own[state] = own[state] + own[fail[state]]
                for c, after in children[state].items():
                    fail[after] = self.next[state, c] if state else 0  # what the state's failure does with the character, before its own child is put in
                    self.next[state, c] = after
        counts = np.array([len(o) for o in own], np.int64)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.own = np.array([k for o in own for k in o], np.int64)
        self.ending = counts > 0

    def find(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all matches: number of the text, of the keyword, and the place where it begins; by text and place."""
        parts = [_points(t or "") for t in texts]
        base = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))  # a gap between texts
        points = np.zeros(int(base[-1]), np.uint32)
        for b, p in zip(base, parts, strict=False):
            points[b : b + len(p)] = p
        words = np.where(points < _KNOWN, _words()[np.minimum(points, _KNOWN - 1)], points < 0x3FFFE)
        low = lowered(points)
        place = np.minimum(np.searchsorted(self.alphabet, low), max(len(self.alphabet) - 1, 0))
        classes = np.where(self.alphabet[place] == low, place + 1, 0) if len(self.alphabet) else np.zeros(len(low), np.int64)
        owns = np.arange(0, len(points), PIECE)
        begins, stops = np.maximum(owns - self.longest + 1, 0), np.minimum(owns + PIECE, len(points))
        order = np.argsort(begins - stops, kind="stable")
        owns, begins, sizes = owns[order], begins[order], (stops - begins)[order]
        states, ends, found = np.zeros(len(owns), np.int32), [], []
        for step in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -step, "left"))  # pieces that have a character here
            at = begins[:n] + step
            states[:n] = self.next[states[:n], classes[at]]
            hit = np.flatnonzero(self.ending[states[:n]])
            hit = hit[at[hit] >= owns[hit]]
            if len(hit):
                ends.append(at[hit])
                found.append(states[hit])
        if not ends:
            return (np.zeros(0, np.int64),) * 3
        end, state = np.concatenate(ends), np.concatenate(found)
        many = self.first[state + 1] - self.first[state]
        nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        keyword, end = self.own[np.repeat(self.first[state], many) + nth], np.repeat(end, many)
        start = end - self.lengths[keyword] + 1
        whole = ~words[np.maximum(start - 1, 0)] | (start == 0)
        whole &= ~words[np.minimum(end + 1, len(words) - 1)]
        keyword, start = keyword[whole], start[whole]
        text = np.searchsorted(base, start, "right") - 1
        order = np.lexsort((keyword, start, text))
        keyword, start, text = keyword[order], start[order], text[order]
        kept = self._apart(text, keyword, start)
        return text[kept], keyword[kept], (start - base[text])[kept]

    def _apart(self, text: np.ndarray, keyword: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Which matches stay, if of one keyword none may begin within the one before that stays."""
        order = np.lexsort((start, keyword, text))
        t, k, s = text[order], keyword[order], start[order]
        near = np.flatnonzero((t[1:] == t[:-1]) & (k[1:] == k[:-1]) & (s[1:] < s[:-1] + self.lengths[k[:-1]])) + 1
        kept = np.ones(len(order), bool)
        for i in near.tolist():
            before = i - 1
            while not kept[order[before]]:
                before -= 1
            kept[order[i]] = not (t[i] == t[before] and k[i] == k[before] and s[i] < s[before] + self.lengths[k[i]])
        return kept
