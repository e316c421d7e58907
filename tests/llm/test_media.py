import hashlib
import random
import zlib

import pytest

from lumbung.llm import media

from .fixtures import documents


def slow_crc(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def test_page_crc():
    for data in (b"", b"a", bytes(range(256))):
        assert media.page_crc(data) == slow_crc(data)


def test_packets_over_pages():
    packets = [bytes([i]) * n for i, n in enumerate([0, 1, 254, 255, 256, 510, 65025, 70000, 200000, 3])]
    w, out = media.StreamWriter(5), []
    for i, p in enumerate(packets):
        out += w.packet(p, i)
    out.append(w.flush(last=True))
    stream = media.decode(b"".join(out))[5]
    assert stream.packets == packets and stream.bad == stream.gaps == 0 and stream.ended and stream.granules[-1] == len(packets) - 1


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 48959, 48960, 48961, 300_000])
def test_round_trip(n):
    text = "".join(random.Random(n).choice("aé ") for _ in range(n))
    payload, size = media.payload_of(text)
    assert len(payload) % 576 == 0 and payload and payload[:size].decode() == text and set(payload[size:]) <= {255}
    streams = media.decode(media.encode(payload))
    sound = next(s for s in streams.values() if s.codec == "PCM")
    back, rate, starts = media.samples(sound)
    assert back == payload and rate == media.RATE and starts == list(range(0, len(payload), 576))
    d = media.digest(text)
    assert d["payload_sha256"] == hashlib.sha256(payload).hexdigest() and d["tail_crc32"] == zlib.crc32(payload[-32:])


def test_damage_is_seen():
    data = bytearray(media.encode(media.payload_of("x" * 200_000)[0]))
    data[100_000] ^= 1
    streams = media.decode(bytes(data))
    assert sum(s.bad + s.gaps for s in streams.values()) >= 1
    assert media.decode(b"no media") == {} and media.decode(bytes(data[:-10]))


def test_edges(spark):
    docs = documents(spark)
    rows = media.digests(docs).collect()
    assert len(rows) == 13
    by = {r["doc_id"]: r for r in rows}
    assert by[4]["payload_sha256"] == by[5]["payload_sha256"] and by[4]["n_bytes"] == 0 and by[4]["payload_bytes"] == 576
    assert by[1]["media_sha256"] == by[2]["media_sha256"] and by[1]["feature"] == by[2]["feature"]
    assert media.digests(documents(spark, [])).collect() == []
    streams = media.demultiplex(media.store(docs)).collect()
    assert len(streams) == 26 and {s["codec"] for s in streams} == {"PCM", "CUES"}
