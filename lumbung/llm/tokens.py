"""Ids of many texts at once, by the tokenizer of a file.

For a tokenizer that lower-cases, splits into letters, single digits and signs between white space, and merges byte pairs (KNOWN states which), a text is split in
numpy. Pieces are encoded once while they are in the cache, and new ones all at once: their merges run in numpy, one for each
piece a round. Words with characters other than plain Latin letters, digits and signs go through the whole tokenizer, each on its own. Texts
of any other tokenizer, and texts that hold one of its special tokens, go through it as they are.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pandas as pd

from . import hashing

#: Pieces whose ids a worker keeps, in two halves: when the newer is full it replaces the older.
CACHE = 300_000
#: Characters that are encoded at once.
CHUNK = 1 << 19
#: Bytes of a piece from which it goes to the tokenizer's own model.
LONG = 64

# What the tokenizer does before its model, as its file says, and the same for words of these characters, which are the same in every Unicode version.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None, "truncation": None, "padding": None,
}
KNOWN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
_PLAIN = "!-~À-ÖØ-öø-įı-ſ"
_BLANKS = " \t\n\r\x0b\x0c"
_ODD = re.compile(f"[^{_PLAIN}{_BLANKS}]")
_BLANK = re.compile(f"[{_BLANKS}]")
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _kinds() -> np.ndarray:
    """Of each byte of lower-case UTF-8 in those letters: 0 blank, 1 letter, 2 digit, 3 sign."""
    kinds = np.full(256, 3, np.int8)
    kinds[list(_BLANKS.encode())] = 0
    kinds[[*range(ord("a"), ord("z") + 1), 0xC3, 0xC4, 0xC5, *range(0x80, 0xC0)]] = 1
    kinds[ord("0") : ord("9") + 1] = 2
    return kinds


_KIND = _kinds()


def split(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of a text begin and end: runs of letters, single digits, runs of signs; an apostrophe that begins a run takes one of _ENDINGS with it."""
    array = np.frombuffer(data, np.uint8)
    kind = _KIND[array]
    before = np.concatenate(([0], kind[:-1])) if len(kind) else kind
    start = (kind != before) | (kind == 2)
    quote = np.flatnonzero((array == ord("'")) & (before != 3))
    if len(quote):
        padded = np.concatenate([array, np.zeros(3, np.uint8)])
        one, two, size = padded[quote + 1], padded[quote + 2], np.zeros(len(quote), np.int64)
        for ending in reversed(_ENDINGS):
            hit = one == ending[0]
            size[hit if len(ending) == 1 else hit & (two == ending[1])] = 1 + len(ending)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = (quote + size)[quote + size < len(array)]
        start[after] |= kind[after] > 0
    begins = np.flatnonzero(start & (kind > 0))
    # a piece ends where the next begins, or at the blank before it
    blank = np.flatnonzero(kind == 0)
    follows = np.append(begins[1:], len(array))
    at = np.searchsorted(blank, begins)
    ends = np.minimum(follows, np.append(blank, len(array))[at])
    return begins, ends


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write visible Latin-1 bytes as themselves and the others, in order, as the letters from 256 on."""
    seen = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """Byte-pair merges of many pieces at once."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str) -> None:
        letters = byte_letters()
        self.inner = np.array([vocabulary[letters[b]] for b in range(256)])
        self.final = np.array([vocabulary[letters[b] + suffix] for b in range(256)])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs])
        self.none = len(pairs)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = np.append(keys[order], -1), np.append(order, self.none), made

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How early each pair is merged; none if it isn't."""
        key = a << 32 | b
        at = np.searchsorted(self.keys[:-1], key)
        return np.where(self.keys[at] == key, self.rank[at], self.none)

    def run(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has. Each round merges the first of the earliest pairs of every piece."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        if not len(sizes):
            return np.zeros(0, np.int64), sizes
        data = np.frombuffer(b"".join(pieces), np.uint8)
        symbol, last = self.inner[data], np.cumsum(sizes) - 1
        symbol[last] = self.final[data[last]]
        piece = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbol), self.none)
        inside = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inside] = self.ranks(symbol[inside], symbol[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
            counts = np.diff(np.append(starts, len(piece)))
            least = np.repeat(np.minimum.reduceat(rank, starts), counts)
            open_ = least < self.none
            if not open_.all():
                done.append((piece[~open_], symbol[~open_]))
                symbol, piece, rank, least = symbol[open_], piece[open_], rank[open_], least[open_]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == least)
            at = at[np.concatenate(([True], piece[at[1:]] != piece[at[:-1]]))]
            symbol[at] = self.made[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # where they are once the second of each pair is gone
            symbol, piece, rank = symbol[keep], piece[keep], rank[keep]
            rank[at] = self.none
            for left in (at[(at + 1 < len(piece)) & (piece[np.minimum(at + 1, len(piece) - 1)] == piece[at])], at[(at > 0) & (piece[at - 1] == piece[at])] - 1):
                rank[left] = self.ranks(symbol[left], symbol[left + 1])
        piece = np.concatenate([d[0] for d in done])
        order = np.argsort(piece, kind="stable")
        return np.concatenate([d[1] for d in done])[order], np.bincount(piece, minlength=len(sizes))


class Encoder:
    """Ids of texts, without special tokens around them."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        model = config["model"]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.merges: Merges | None = None
        suffix = model.get("end_of_word_suffix") or ""
        if all(config.get(k) == v for k, v in KNOWN.items()) and all(model.get(k) == v for k, v in KNOWN_MODEL.items()):
            if all(x in model["vocab"] and x + suffix in model["vocab"] for x in byte_letters().values()):
                self.merges = Merges(model["vocab"], model["merges"], suffix)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _fresh(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, as little-endian 32-bit bytes."""
        long = [i for i, p in enumerate(pieces) if len(p) > LONG]
        short = list(pieces)
        for i in long:
            short[i] = b""
        ids, counts = self.merges.run(short)
        data, place = ids.astype("<u4").tobytes(), [0, *(4 * np.cumsum(counts)).tolist()]
        out = [data[a:b] for a, b in zip(place, place[1:], strict=False)]
        letters = byte_letters() if long else {}
        for i in long:
            out[i] = np.array([t.id for t in self.tokenizer.model.tokenize("".join(letters[b] for b in pieces[i]))], "<u4").tobytes()
        return out

    def _known(self, keys: list[bytes], make) -> list[bytes]:
        """Ids of keys from the cache, or made and put there."""
        values = list(map(self.known.get, keys))
        new = [i for i, v in enumerate(values) if v is None]
        if new:
            if len(self.known) > CACHE // 2:
                self.older, self.known = self.known, {}
            names = [keys[i] for i in new]
            found = list(map(self.older.get, names))
            fresh = iter(make([k for k, v in zip(names, found, strict=True) if v is None]))
            found = [next(fresh) if v is None else v for v in found]
            self.known.update(zip(names, found, strict=True))
            for i, v in zip(new, found, strict=True):
                values[i] = v
        return values

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; none for null ones."""
        out: list[np.ndarray | None] = [None] * len(texts)
        runs: list[str] = []  # plain texts, and odd words on their own
        owner: list[int] = []
        odd: list[int] = []
        for i, t in enumerate(texts):
            if not t:
                out[i] = np.zeros(0, "<u4")
                continue
            if self.merges is None or any(s in t for s in self.special):
                out[i] = self.whole(t)
                continue
            parts, begin = [], 0
            for m in _ODD.finditer(t):
                if m.start() < begin:
                    continue
                start = m.start()
                while start > begin and t[start - 1] not in _BLANKS:
                    start -= 1
                if start > begin:
                    parts += cut_at_blanks(t[begin:start])
                blank = _BLANK.search(t, m.end())
                odd.append(len(runs) + len(parts))
                begin = blank.start() if blank else len(t)
                parts.append(t[start:begin])
            parts += cut_at_blanks(t[begin:])
            runs += parts
            owner += [i] * len(parts)
        plain = list(runs)
        for i in odd:
            plain[i] = ""
        found = [x for a, b in hashing.chunks(plain, CHUNK) for x in self._chunk(plain[a:b])]
        if odd:
            values = self._known([b" " + runs[i].encode("utf-8", "surrogatepass") for i in odd], lambda keys: [self.whole(k[1:].decode("utf-8", "replace")).tobytes() for k in keys])
            for i, v in zip(odd, values, strict=True):
                found[i] = np.frombuffer(v, "<u4")
        at = 0
        while at < len(runs):
            i = owner[at]
            end = at + 1
            while end < len(runs) and owner[end] == i:
                end += 1
            out[i] = found[at] if end == at + 1 else np.concatenate(found[at:end])
            at = end
        return out

    def _chunk(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts."""
        raw = [t.lower().encode() for t in texts]
        base = np.cumsum([0, *(len(r) + 1 for r in raw)])
        data = b" ".join([*raw, b""])
        begins, ends = split(data)
        place, known = pd.factorize(hashing.spans(data, begins, ends))
        at = np.zeros(len(known), np.int64)
        at[place[::-1]] = np.arange(len(place) - 1, -1, -1)  # where each comes first
        values = self._known([data[a:b] for a, b in zip(begins[at].tolist(), ends[at].tolist(), strict=True)], self._fresh)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        ids, starts = np.frombuffer(b"".join(values), "<u4"), np.cumsum(sizes) - sizes
        each = sizes[place]
        until = np.concatenate(([0], np.cumsum(each)))
        all_ = ids[np.repeat(starts[place] - until[:-1], each) + np.arange(until[-1])] if len(each) else np.zeros(0, "<u4")
        bounds = until[np.searchsorted(begins, base)].tolist()
        return [all_[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def cut_at_blanks(text: str, size: int = CHUNK) -> list[str]:
    """Parts of at least `size` characters, but for the last, that end at a blank: what is held at once does not grow with the text."""
    out, begin = [], 0
    while len(text) - begin > size:
        m = _BLANK.search(text, begin + size)
        if m is None:
            break
        out.append(text[begin : m.start()])
        begin = m.start()
    return [*out, text[begin:]]
