"""Personal data in texts, also where it is disguised, with spans in the source text.

Plain identifiers are found by patterns in the text as it is. Then transducers rewrite disguises and keep, for every piece that they
changed, where it came from:

1. homoglyphs: full-width, mathematical, Cyrillic and Greek look-alikes and digits of other scripts to ASCII; invisible characters go;
2. spelled digits: runs of three or more digits, at least two of them words of English, German, French or Spanish ("five five five", "double two",
   "plus eins"), to digits;
3. disguised signs: "[at]", "(dot)", "name at host dot org", "name arroba host punto es" to @ and full stops.

The same patterns run over what the transducers give; their spans are mapped back through all of them to the source. Names and hosts may have any length.

Disguised dots count between the numbers of an IP address and the digits of a phone number too ("192[.]168[.]1[.]1", "10 dot 0 dot 0 dot 1").

What words alone can't tell from prose stays: a bare "at" counts only before a host with a spelled dot and no article before that dot ("at the dot in"). Its last label may be any word if one like "mail" is
before the address, if the name has a digit, sign or dot in it, or if there are two spelled dots; otherwise it must be one of ENDINGS or have two letters. Before a
host with plain dots a bare "at" counts only with such a word or name.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

KINDS = ("email", "ip", "card", "phone")

# The patterns of plain identifiers and their bounds.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match cannot begin within a run of digits: it would at its start
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
CARD_DIGITS, PHONE_DIGITS, IP_MOST = (13, 19), (9, 15), 255

# Spelled digits, look-alike letters and invisible characters.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
TIMES = {"double": 2, "triple": 3, "doppel": 2, "dreifach": 3, "doble": 2}
DOTS, ATS, PLUS = ("dot", "point", "punkt", "punto"), ("arroba", "arobase"), ("plus", "más")
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Ζ": "Z", "ı": "i", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", "﹒": ".",
    "﹫": "@", " ": " ", " ": " ", " ": " ",
}
# Endings of three letters or more of a host whose dots are spelled without brackets, articles that are no host there, and words that an address follows.
ENDINGS = frozenset(
    "com org net edu gov mil int info biz app dev example test online site shop store xyz club blog news cloud tech email live world pro name mobi travel jobs asia top web page "
    "software agency media digital studio solutions services systems network company group global academy consulting design marketing software technology university school college "
    "health care clinic law legal finance bank capital money energy engineering expert foundation gallery guide hosting institute international house land life love ltd gmbh llc inc "
    "management museum photo photography press productions properties restaurant review science security social space support team tools tours training video wiki works zone coop aero post tel arpa local internal localhost invalid".split()
)
ARTICLES = frozenset("the a an this that each every one any der die das den dem ein eine le la les un une el los las una".split())
_CUE = re.compile(r"(?:e-?mail|mail|mailto|contact|reach|write|kontakt|courriel|correo)\W+(?:(?:me|us|to|is|an|à|a)\W+)*\Z", re.I)
INVISIBLE = "­​‌‍⁠﻿"

_ODD = re.compile("[" + re.escape("".join(LOOKALIKES) + INVISIBLE) + r"٠-٩۰-۹०-९！-～\U0001d400-\U0001d7ff]")
_WORDS = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_NUMBER = rf"(?:(?:{'|'.join(TIMES)})[\s-]+)?(?:{_WORDS})|[0-9]"
_RUN = re.compile(rf"(?<!\w)(?:(?:{'|'.join(PLUS)})[\s-]*)?(?:{_NUMBER})(?!\w)(?:(?:[\s,.-]{{1,3}}|\s*\(|\)\s*|[\s,-]+(?:{'|'.join(DOTS)})[\s,-]+)(?:{_NUMBER})(?!\w))+", re.I)
_TOKEN = re.compile(r"\w+|\W+")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
# blanks before a sign are looked at from where they begin, so that long ones are read once
_OPEN, _CLOSE = r"(?<!\s)\s*+[\[({<]\s*+", r"\s*+[\])}>]\s*+"
_AT = re.compile(rf"(?P<sure>{_OPEN}(?:at|@|{'|'.join(ATS)}){_CLOSE}|(?<![ \t])[ \t]++(?:{'|'.join(ATS)})[ \t]++)|(?<![ \t])(?:[ \t]++at[ \t]++|[ \t]*+@[ \t]*+)", re.I)
_DOT = re.compile(rf"(?P<sure>{_OPEN}(?:{'|'.join(DOTS)}|\.){_CLOSE})|(?<![ \t])[ \t]++(?P<word>{'|'.join(DOTS)})[ \t]++|\.", re.I)
_POINT = rf"(?:\s*+[\[({{<]\s*+(?:{'|'.join(DOTS)}|\.)\s*+[\])}}>]\s*+|[ \t]++(?:{'|'.join(DOTS)})[ \t]++)"
_POINTS = re.compile(_POINT, re.I)
_POINTED = re.compile(rf"[0-9]{_POINT}[0-9]", re.I)
_QUAD = re.compile(rf"(?<![0-9])[0-9]++(?:(?:{_POINT}|\.)[0-9]++){{3}}", re.I)
_CALL = re.compile(rf"\+[0-9](?:{_POINT}|[\x20().0-9-])*[0-9]", re.I)
_BRACKETED = re.compile(rf"[\[({{<]\s*+(?:at|@|{'|'.join(ATS + DOTS)}|\.)\s*+[\])}}>]", re.I)
_BARE_WORDS = re.compile(rf"[ \t](?:{'|'.join(ATS + DOTS)})[ \t]", re.I)
_AT_HOST = re.compile(r"[ \t]at[ \t]++[A-Za-z0-9-]++\.", re.I)
_ALL_WORDS = re.compile(r"\w+")
_IN_RUNS = frozenset(DIGIT_WORDS) | frozenset(TIMES) | frozenset(DOTS) | frozenset(PLUS) | frozenset("0123456789")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= IP_MOST


def detect(text: str) -> list[tuple[int, int, int]]:
    """Plain identifiers as (place in KINDS, start, end), sorted; leftmost and non-overlapping in each kind, those that fail their bounds left out."""
    found: list[tuple[int, int, int]] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((0, start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _DIGIT.search(text):
        found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_number, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append((2, *m.span()))
        if "+" in text:
            found += [(3, *m.span()) for m in _PHONE.finditer(text) if PHONE_DIGITS[0] <= sum(c.isdigit() for c in m[0]) <= PHONE_DIGITS[1]]
    return found


class Mapped:
    """A rewritten text and where its pieces came from: starts in it, and the (start, end) in the source of each."""

    def __init__(self, text: str) -> None:
        self.text, self.starts, self.source = text, [0], [(0, len(text))]
        self.same = [True]

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces (start, end) by a text, for edits in order that don't overlap; a deletion is an empty text."""
        if not edits:
            return
        out, starts, source, same, at, size = [], [], [], [], 0, 0

        def add(text: str, begin: int, end: int, kept: bool) -> None:
            nonlocal size
            if not text:
                return
            out.append(text)
            starts.append(size)
            source.append((begin, end))
            same.append(kept)
            size += len(text)

        for start, end, new in edits:
            self._keep(at, start, add)
            add(new, self.back(start, start)[0] if start == end else self.back(start, end)[0], self.back(start, end)[1], False)
            at = end
        self._keep(at, len(self.text), add)
        self.text, self.starts, self.source, self.same = "".join(out), starts or [0], source or [(0, 0)], same or [True]

    def _keep(self, begin: int, end: int, add) -> None:
        while begin < end:
            i = bisect_right(self.starts, begin) - 1
            stop = min(end, self.starts[i + 1] if i + 1 < len(self.starts) else len(self.text))
            a, b = self.source[i]
            if self.same[i]:
                a = self.source[i][0] + begin - self.starts[i]
                b = a + stop - begin
            add(self.text[begin:stop], a, b, self.same[i])
            begin = stop

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The source's span of text[start:end]; a piece that was replaced counts as a whole."""
        i, j = bisect_right(self.starts, start) - 1, bisect_right(self.starts, max(start, end - 1)) - 1
        a = self.source[i][0] + (start - self.starts[i] if self.same[i] else 0)
        b = self.source[j][0] + end - self.starts[j] if self.same[j] else self.source[j][1]
        return a, b


def _plain(char: str) -> str | None:
    """The ASCII that a look-alike stands for; None to keep it."""
    if char in INVISIBLE:
        return ""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    if (digit := unicodedata.digit(char, None)) is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", char)
    plain = LOOKALIKES.get(plain, plain)
    return plain if len(plain) == 1 and plain.isascii() else None


def _letters(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), new) for m in _ODD.finditer(text) if (new := _plain(m[0])) is not None]


def _spelled(run: str) -> str | None:
    """Digits of a run of numbers; None if it has under three, or under two words among them."""
    out, words, digits, times = "", 0, 0, 1
    for token in _TOKEN.findall(run):
        low = token.lower()
        if low in TIMES:
            times = TIMES[low]
        elif low in PLUS:
            out += "+"
        elif low in DOTS:
            out = out.rstrip(" -") + "."
        elif low in DIGIT_WORDS or low.isdigit():
            words += low in DIGIT_WORDS
            digits += times
            out += DIGIT_WORDS.get(low, low) * times
            times = 1
        elif "." in token:
            out += "."
    return out if digits >= 3 and words >= 2 else None


def _digits(text: str) -> list[tuple[int, int, str]]:
    last, streak, longest = -2, 0, 0  # digit words in a row, with nothing but what runs have between
    words = _ALL_WORDS.findall(text.lower())
    for i in [i for i, w in enumerate(words) if w in _IN_RUNS]:
        streak = (streak if i == last + 1 else 0) + (words[i] in DIGIT_WORDS)
        last, longest = i, max(longest, streak)
    if longest < 2:
        return []
    return [(m.start(), m.end(), new) for m in _RUN.finditer(text) if (new := _spelled(m[0])) is not None]


def _numbers(text: str) -> list[tuple[int, int, str]]:
    """Edits of the disguised dots within IP addresses and phone numbers."""
    edits: dict[int, tuple[int, int, str]] = {}
    if not _POINTED.search(text):
        return []
    for m in _QUAD.finditer(text):
        if all(map(_number, re.findall("[0-9]+", m[0]))):
            edits |= {m.start() + p.start(): (m.start() + p.start(), m.start() + p.end(), ".") for p in _POINTS.finditer(m[0])}
    for m in _CALL.finditer(text) if "+" in text else ():
        if PHONE_DIGITS[0] <= sum(c.isdigit() for c in m[0]) <= PHONE_DIGITS[1]:
            edits |= {m.start() + p.start(): (m.start() + p.start(), m.start() + p.end(), ".") for p in _POINTS.finditer(m[0])}
    return [edits[k] for k in sorted(edits)]


def _disguised(text: str) -> bool:
    """Whether a text has any sign that _signs() could take for another."""
    if any(x in text for x in "[({<") and _BRACKETED.search(text):
        return True
    low = text.lower()
    return any(w in low for w in ATS + DOTS) and bool(_BARE_WORDS.search(text)) or " at " in low.replace("\t", " ") and bool(_AT_HOST.search(text))


def _signs(text: str) -> list[tuple[int, int, str]]:
    """Edits of the disguised signs in addresses: around every sign that may stand for @, the name before and the host after it are read as far as they go."""
    edits: list[tuple[int, int, str]] = []
    if not _disguised(text):
        return edits
    before = {m.end(): m for m in _DOT.finditer(text)}
    free = 0
    for at in _AT.finditer(text):
        if at.start() < free:
            continue
        name = _name(text, at.start(), free, before)
        host = _host(text, at.end()) if name else []
        if not host:
            continue
        start = name[0]
        if at["sure"]:
            # a spelled dot after the host may be prose, unless an ending follows or nothing else is there
            good = [i for i, (dot, label) in enumerate(host) if not dot["word"] or _ends(label)] or [0]
        else:
            disguised = [i for i, (dot, label) in enumerate(host) if dot["sure"] or dot["word"]]
            told = "@" not in at[0] and (any(not c.isalpha() for c in text[start : at.start()]) or bool(_CUE.search(text, max(0, start - 40), start)))
            any_ending = told or len(disguised) + len(name[1]) > 1
            ended = lambda i: _ends(host[i][1]) or (any_ending and len(host[i][1]) > 1 and host[i][1].isalpha() and host[i][1].lower() not in ARTICLES)  # noqa: E731, B023
            good = [i for i in disguised if host[i][0]["sure"] or (ended(i) and _before(text, host[i][0]).lower() not in ARTICLES)]
            if not disguised and told and _ends(host[-1][1]):
                good = [len(host) - 1]
        if good:
            host = host[: good[-1] + 1]
            edits += [(d.start(), d.end(), ".") for d in [*name[1], *(dot for dot, _ in host)] if d[0] != "."] + [(at.start(), at.end(), "@")]
            free = host[-1][0].end() + len(host[-1][1])
    return sorted(edits)


def _ends(label: str) -> bool:
    return label.isalpha() and (len(label) == 2 or label.lower() in ENDINGS)


def _before(text: str, dot: re.Match) -> str:
    """The label before a dot."""
    at = dot.start()
    while at and text[at - 1] in _NAME:
        at -= 1
    return text[at : dot.start()]


def _name(text: str, end: int, least: int, before: dict[int, re.Match]) -> tuple[int, list[re.Match]] | None:
    """Where the name before a sign begins, and its dots; None without a name. before: dots by their end."""
    start, dots, at, pending = None, [], end, None
    while True:
        begin = at
        while begin > least and text[begin - 1] in _NAME:
            begin -= 1
        if begin == at:
            break
        if pending is not None:
            dots.append(pending)
        start, pending = begin, before.get(begin)
        if pending is None or pending.start() < least:
            break
        at = pending.start()
    return None if start is None else (start, dots[::-1])


def _host(text: str, at: int) -> list[tuple[re.Match, str]]:
    """The dots of the host that begins at a place, each with the label after it; none if there is no dot."""
    found: list[tuple[re.Match, str]] = []
    label = _LABEL.match(text, at)
    while label and (dot := _DOT.match(text, label.end())) and (label := _LABEL.match(text, dot.end())):
        found.append((dot, label[0]))
    return found


def find(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: those and the ones that only the transducers show. Spans are (place in KINDS, start, end) in code points.

    A span that overlaps a base span of its kind isn't added: base spans stay as they are. Null and empty texts have none.
    """
    text = text or ""
    base = detect(text)
    mapped = Mapped(text)
    if not text.isascii():
        mapped.rewrite(_letters(mapped.text))
    mapped.rewrite(_digits(mapped.text))
    mapped.rewrite(_numbers(mapped.text))
    mapped.rewrite(_signs(mapped.text))
    if len(mapped.starts) == 1 and mapped.same[0]:
        return base, base
    known = [([s for k, s, _ in base if k == kind], [e for k, _, e in base if k == kind]) for kind in range(len(KINDS))]
    added, ends = [], [0] * len(KINDS)
    for kind, start, end in detect(mapped.text):
        a, b = mapped.back(start, end)
        starts, stops = known[kind]
        at = bisect_right(stops, a)  # the first base span that ends after a
        if a >= ends[kind] and not (at < len(starts) and starts[at] < b):
            added.append((kind, a, b))
            ends[kind] = b
    return base, sorted(base + added)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"


def scan(docs: DataFrame) -> DataFrame:
    """A row for each row of docs (doc_id, text): counts of base spans by kind, their digest, all spans, and how many.

    Texts of any length are read whole, in time that grows with it. Null and empty texts have no spans: counts 0, the digest of nothing. Each row is on its own, repeated ones give equal values; an empty table
    gives no rows; other columns do not matter.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                base, spans = find(text)
                counts = [0] * len(KINDS)
                for kind, _, _ in base:
                    counts[kind] += 1
                rows.append((doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return map_texts(docs, run, SCHEMA)


def base_values(docs: DataFrame) -> DataFrame:
    """doc_id, kind, value and n, how often the document has it, of all base spans."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, KINDS[k], t[s:e]) for i, t in zip(b["doc_id"], b["text"], strict=True) if t for k, s, e in find(t)[0]]
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "value"])

    return map_texts(docs, run, "doc_id long, kind string, value string").groupBy("doc_id", "kind", "value").agg(F.count(F.lit(1)).alias("n"))


#: The base patterns and bounds in SQL; a card's digits are checked by Luhn's rule from the right.
BASE_SQL = r"""
with found as (
  select doc_id, 'email' as kind, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+')) as value from documents
  union all select doc_id, 'ip', unnest(regexp_extract_all(text, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)')) from documents
  union all select doc_id, 'card', unnest(regexp_extract_all(text, '[0-9]([\x20-]?[0-9])+')) from documents
  union all select doc_id, 'phone', unnest(regexp_extract_all(text, '\+[0-9][\x20().0-9-]+[0-9]')) from documents),
digits as (select *, regexp_replace(value, '[^0-9]', '', 'g') as d from found),
checked as (
  select doc_id, kind, value from digits where case kind
    when 'email' then true
    when 'ip' then len(list_filter(string_split(value, '.'), lambda p: try_cast(p as hugeint) is null or p::hugeint > 255)) = 0
    when 'phone' then length(d) between 9 and 15
    else length(d) between 13 and 19 and list_sum(list_transform(range(1, length(d) + 1),
      lambda i: case when i % 2 = 1 then d[length(d) + 1 - i]::integer else (2 * d[length(d) + 1 - i]::integer) // 10 + (2 * d[length(d) + 1 - i]::integer) % 10 end)) % 10 = 0 end)
select doc_id, kind, value, count(*) as n from checked group by all
"""


def redact(text: str | None, mask: str = "[{}]") -> str | None:
    """The text with each span replaced by mask, in which {} is the kind; of spans that overlap the first counts."""
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end in sorted(find(text)[1], key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], mask.format(KINDS[kind])]
            at = end
    return "".join([*out, text[at:]])
