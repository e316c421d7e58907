"""Words of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}

#: Bytes that separate words, and the same with all ASCII punctuation.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_POWERS.get(name, ())) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[name][:n]


@dataclass
class Words:
    """Words of some texts, in order: first[i] to first[i + 1] are those of text i; starts and ends are byte offsets in data."""

    data: bytes
    base: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    sums: np.ndarray

    def prefix(self, n: int) -> np.ndarray:
        """Hashes of the first n bytes of each word."""
        return _between(self.sums, self.starts, np.minimum(self.ends, self.starts + n))


def _between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    back = _powers("inverse", _INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def _sums(array: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(array) + 1, np.uint64)
    np.cumsum(_BYTE[array] * _powers("power", _BASE, len(array)), out=sums[1:])
    return sums


def spans(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of parts of data."""
    return _between(_sums(np.frombuffer(data, np.uint8)), starts, ends)


def words(texts: list[str | None], table: bytes = LOWER) -> Words:
    """Words of all texts after each byte of their UTF-8 is mapped by table; null texts have none."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    base = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=base[1:])
    data = b" ".join([*raw, b""]).translate(table)
    array = np.frombuffer(data, np.uint8)
    blank = SPACE[array]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    sums = _sums(array)
    return Words(data, base, np.searchsorted(starts, base), starts, ends, _between(sums, starts, ends), sums)


def chunks(texts: list[str | None], size: int = 1 << 18) -> list[tuple[int, int]]:
    """Ranges of texts with about `size` characters each, to bound what is held at once; a longer text is alone in its range."""
    found, begin, held = [], 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > size:
            found.append((begin, i))
            begin, held = i, 0
        held += n + 1
    if begin < len(texts):
        found.append((begin, len(texts)))
    return found
