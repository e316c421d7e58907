"""Ogg containers: pages with checksums, packets in lacing values, several logical streams, granule positions.

Audio is kept as 8-bit samples in an OggPCM stream; a second, cue stream marks where each block of samples begins and holds
its CRC-32. The two are interleaved page by page, as a multiplexed Ogg file has them.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import map_texts

#: Samples of a packet, packets of a page (three lacing values each; a page has 255), samples a second.
FRAME, PAGE_FRAMES, RATE = 576, 85, 8000
_MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))
_HEAD = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4


def page_crc(data: bytes) -> int:
    """Ogg's checksum: polynomial 0x04C11DB7, bits from the left, from 0. zlib's runs from the right, so bits are mirrored before and after."""
    value = zlib.crc32(data.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(value.to_bytes(4, "little").translate(_MIRROR), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = _HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    crc = page_crc(head + body)
    return head[:22] + struct.pack("<I", crc) + head[26:] + body


def lacing_of(size: int) -> bytes:
    return b"\xff" * (size // 255) + bytes([size % 255])


class StreamWriter:
    """Packets of one logical stream to pages; a packet that does not fit goes on in the next page."""

    def __init__(self, serial: int) -> None:
        self.serial, self.number, self.lacing, self.body, self.granule, self.inside = serial, 0, bytearray(), bytearray(), -1, False

    def packet(self, data: bytes, granule: int) -> list[bytes]:
        """Adds a packet, after which the stream is at granule; returns the pages that became full."""
        out, values, at = [], lacing_of(len(data)), 0
        while values:
            room = 255 - len(self.lacing)
            take, values = values[:room], values[room:]
            n = sum(take)
            self.lacing += take
            self.body += data[at : at + n]
            at += n
            if not values:
                self.granule = granule
            if len(self.lacing) == 255:
                out.append(self.flush(more=bool(values)))
        return out

    def flush(self, more: bool = False, last: bool = False) -> bytes:
        """The page so far. more: its last packet isn't complete."""
        flags = CONTINUED * self.inside | FIRST * (self.number == 0) | LAST * last
        page = _page(flags, self.granule, self.serial, self.number, bytes(self.lacing), bytes(self.body))
        self.number, self.lacing, self.body, self.granule, self.inside = self.number + 1, bytearray(), bytearray(), -1, more
        return page


def encode(payload: bytes, rate: int = RATE) -> bytes:
    """A multiplexed file with payload's bytes as mono 8-bit samples; its length is a multiple of FRAME. Equal payloads give equal files."""
    serial = zlib.crc32(payload)
    sound, cues = StreamWriter(serial), StreamWriter(serial ^ 0xFFFFFFFF)
    head = b"PCM     " + struct.pack(">HHIIBBHI", 0, 0, 1, rate, 8, 1, FRAME, 0)
    out = [*sound.packet(head, 0), sound.flush(), *cues.packet(b"CUES    " + struct.pack(">I", rate), 0), cues.flush()]
    block, full = FRAME * PAGE_FRAMES, lacing_of(FRAME) * PAGE_FRAMES
    for at in range(0, len(payload), block):
        part, end = payload[at : at + block], at + block >= len(payload)
        out += cues.packet(struct.pack(">QI", at, zlib.crc32(part)), at)
        out.append(cues.flush(last=end))
        lacing = full[: len(part) // FRAME * 3]
        out.append(_page(LAST * end, at + len(part), sound.serial, sound.number, lacing, part))
        sound.number += 1
    return b"".join(out)


@dataclass
class Stream:
    """A logical stream as read: packets with the granule position after each (-1: not known), counts of pages, of wrong checksums and of gaps."""

    serial: int
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)
    pages: int = 0
    bad: int = 0
    gaps: int = 0
    ended: bool = False
    _rest: list[bytes] = field(default_factory=list)
    _next: int = 0

    @property
    def codec(self) -> str:
        return self.packets[0][:8].decode("ascii", "replace").strip() if self.packets else ""


def decode(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number. Pages whose checksum is wrong are left out, and packets that lack a part too.

    After bytes that are no page, reading goes on at the next capture pattern; a file cut short gives what is whole.
    """
    streams: dict[int, Stream] = {}
    at = data.find(b"OggS")
    while 0 <= at and at + 27 <= len(data):
        _, version, flags, granule, serial, number, crc, n = _HEAD.unpack_from(data, at)
        body = at + 27 + n
        lacing = data[at + 27 : body]
        end = body + sum(lacing)
        if version or len(lacing) < n or end > len(data) or page_crc(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            if serial in streams:
                streams[serial].bad += 1
            at = data.find(b"OggS", at + 4)
            continue
        stream = streams.setdefault(serial, Stream(serial))
        stream.pages += 1
        lost = number != stream._next
        stream.gaps += lost
        stream._next = number + 1
        if lost or not flags & CONTINUED:
            stream._rest = []
        skip = bool(flags & CONTINUED) and not stream._rest  # the rest of a packet whose beginning is lost
        ends, size = [], 0
        for value in lacing:
            size += value
            if value < 255:
                ends.append(size)
                size = 0
        place = body
        for i, length in enumerate(ends):
            part = data[place : place + length]
            place += length
            if i == 0 and skip:
                continue
            if i == 0 and stream._rest:
                part = b"".join([*stream._rest, part])
                stream._rest = []
            stream.packets.append(part)
            stream.granules.append(granule if i == len(ends) - 1 else -1)
        if size or (lacing and lacing[-1] == 255):
            if not (skip and not ends):
                stream._rest.append(data[place:end])
        stream.ended |= bool(flags & LAST)
        at = end if data[end : end + 4] == b"OggS" or end >= len(data) else data.find(b"OggS", end)
    return streams


def samples(stream: Stream) -> tuple[bytes, int, list[int]]:
    """Samples of an OggPCM stream, its rate, and the position of the first sample of each packet.

    Positions come from the pages' granule positions, counted back over the packets that end in the same page.
    """
    _, _, _, rate, _, _, frame, _ = struct.unpack(">HHIIBBHI", stream.packets[0][8:28])
    sound, granules = stream.packets[1:], stream.granules[1:]
    starts, known = [0] * len(sound), None
    for i in range(len(sound) - 1, -1, -1):
        known = granules[i] if granules[i] >= 0 else known
        if known is not None:
            known -= len(sound[i])
            starts[i] = known
    return b"".join(sound), rate, starts


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 of text with bytes 255 up to a positive multiple of FRAME, and the length without them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (max(1, -(-len(raw) // FRAME)) * FRAME - len(raw)), len(raw)


def digest(text: str | None) -> dict:
    """What the stored form of a text gives when it is read back."""
    payload, size = payload_of(text)
    stored = encode(payload)
    streams = decode(stored)
    sound = next(s for s in streams.values() if s.codec == "PCM")
    cues = next(s for s in streams.values() if s.codec == "CUES")
    back, rate, starts = samples(sound)
    marks = [struct.unpack(">QI", p) for p in cues.packets[1:]]
    right = sum(zlib.crc32(back[at : at + FRAME * PAGE_FRAMES]) == crc for at, crc in marks)
    wave = np.frombuffer(back, np.uint8)
    above = wave >= 128
    feature = ":".join(map(str, (
        len(streams), sound.pages + cues.pages, sound.bad + sound.gaps + cues.bad + cues.gaps, len(sound.packets) - 1, f"{right}/{len(marks)}",
        1000 * starts[-1] // rate, 1000 * len(back) // rate, int(wave.sum(dtype=np.int64)) * 1000 // len(wave),
        int(np.count_nonzero(above[1:] != above[:-1])),
    )))
    return {
        "n_bytes": size, "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-32:]),
        "media_bytes": len(stored), "media_sha256": hashlib.sha256(stored).hexdigest(), "feature": feature,
    }


DIGEST_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digests(docs: DataFrame) -> DataFrame:
    """A row of digest() for each row of docs (doc_id, text), in its order. Null and empty texts are one frame of bytes 255.

    Each text is stored, read and forgotten before the next: only a batch of texts is held. Rows are on their own, so
    repeated rows give equal values, an empty table gives no rows and other columns do not matter.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = pd.DataFrame([digest(t) for t in b["text"]], columns=[c.split()[0] for c in DIGEST_SCHEMA.split(", ")][1:])
            found.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield found

    return map_texts(docs, run, DIGEST_SCHEMA)


#: Sizes and digests of payloads in SQL.
PAYLOAD_SQL = r"""
with raw as (select doc_id, encode(coalesce(text, '')) as b from documents),
padded as (select doc_id, octet_length(b) as n, b, greatest(1, (octet_length(b) + 575) // 576) * 576 as size from raw)
select doc_id, n::bigint as n_bytes, size::bigint as payload_bytes, sha256(b || repeat('\xFF'::blob, size - n)) as payload_sha256 from padded
"""


def store(docs: DataFrame) -> DataFrame:
    """doc_id and media, the stored form of each text as a file's bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "media": [encode(payload_of(t)[0]) for t in b["text"]]})

    return map_texts(docs, run, "doc_id long, media binary")


def demultiplex(files: DataFrame, key: str = "doc_id", media: str = "media") -> DataFrame:
    """A row for each logical stream of each file: serial, codec, pages, bad, gaps, packets, bytes and ended; null or foreign files have none."""
    schema = f"{key} {dict(files.dtypes)[key]}, serial long, codec string, pages int, bad int, gaps int, packets int, bytes long, ended boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [
                (k, s.serial, s.codec, s.pages, s.bad, s.gaps, len(s.packets), sum(map(len, s.packets)), s.ended)
                for k, m in zip(b[key], b[media], strict=True)
                if m is not None
                for s in decode(bytes(m)).values()
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return files.select(key, media).mapInPandas(run, schema)
