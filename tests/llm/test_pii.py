import hashlib
import random
import re

import pytest

from lumbung.llm import pii

from .fixtures import documents

MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    digits = lambda x: re.sub("[^0-9]", "", x)
    found = [(0, *m.span()) for m in MAIL.finditer(t)] + [(1, *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [(2, *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return found + [(3, *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m[0])) <= 15]


def test_base_patterns():
    r = random.Random(3)
    for _ in range(20_000):
        t = "".join(r.choice("a1.@+ -()2.9@b_") for _ in range(r.randint(0, 40)))
        assert pii.detect(t) == brute(t), t
        t = "".join(r.choice(["4111", "1111", " ", "-", ".", "192", "1", "+", "@", "a", "555", "("]) for _ in range(r.randint(0, 14)))
        assert pii.detect(t) == brute(t), t


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail jo.doe [at] example (dot) com now", "email", "jo.doe [at] example (dot) com"),
        ("jane dot roe at mail dot example dot org!", "email", "jane dot roe at mail dot example dot org"),
        ("call plus one, five five five - zero one two three nine nine nine ok", "phone", "plus one, five five five - zero one two three nine nine nine"),
        ("ip one nine two dot one six eight dot one dot two zero", "ip", "one nine two dot one six eight dot one dot two zero"),
        ("я аdmin@exаmple.com", "email", "аdmin@exаmple.com"),
        ("😀 ｕser＠host．org", "email", "ｕser＠host．org"),
        ("four" + " one" * 15, "card", "four" + " one" * 15),
        ("x " + "n" * 400 + " at host dot com", "email", "n" * 400 + " at host dot com"), ("a" + ".b" * 40 + " [at] " + "c (dot) " * 30 + "org", "email", "a" + ".b" * 40 + " [at] " + "c (dot) " * 30 + "org"),
        ("jo at host dot online", "email", "jo at host dot online"), ("jane at example dot it, ok", "email", "jane at example dot it"), ("juan arroba correo punto es", "email", "juan arroba correo punto es"),
        ("mail jane at example.com or call", "email", "jane at example.com"), ("see jo.doe at example.com.", "email", "jo.doe at example.com"), ("eva [at] firma punkt de", "email", "eva [at] firma punkt de"),
        ("plus drei vier - " + " ".join(["cinco"] * 4 + ["eins", "zwei", "drei"]), "phone", "plus drei vier - " + " ".join(["cinco"] * 4 + ["eins", "zwei", "drei"])),
        ("más tres cuatro nueve uno dos tres cuatro cinco seis", "phone", "más tres cuatro nueve uno dos tres cuatro cinco seis"), ("plus trois trois un deux huit neuf zéro sept six cinq", "phone", "plus trois trois un deux huit neuf zéro sept six cinq"),
        ("at 192[.]168[.]1[.]1 now", "ip", "192[.]168[.]1[.]1"), ("10 dot 0 dot 0 dot 1", "ip", "10 dot 0 dot 0 dot 1"), ("x 10 (dot) 0 (dot) 0 (dot) 1.", "ip", "10 (dot) 0 (dot) 0 (dot) 1"), ("10.0[.]0.255", "ip", "10.0[.]0.255"),
        ("１９２ punkt １６８ punkt 1 punkt 1", "ip", "１９２ punkt １６８ punkt 1 punkt 1"), ("tel +49[.]30[.]1234567 ok", "phone", "+49[.]30[.]1234567"), ("+1 555 dot 123 dot 4567, dot", "phone", "+1 555 dot 123 dot 4567"), ("+1 (555) 123 point 4567", "phone", "+1 (555) 123 point 4567"),
        ("jo at x dot software", "email", "jo at x dot software"), ("contact jo at x dot anyword", "email", "jo at x dot anyword"), ("jo.b at x dot anyword", "email", "jo.b at x dot anyword"), ("jo dot b at x dot anyword", "email", "jo dot b at x dot anyword"), ("jo at mail dot x dot agency", "email", "jo at mail dot x dot agency"),
        ("un neuf deux point un six huit point un point deux", "ip", "un neuf deux point un six huit point un point deux"),
    ],
)
def test_disguises(text, kind, span):
    base, spans = pii.find(text)
    assert (pii.KINDS.index(kind), text.index(span), text.index(span) + len(span)) in spans and not base
    assert span not in pii.redact(text)


@pytest.mark.parametrize("text", ["Look at the dot matrix printer. It is new.", "We met at noon at one of two or three places.", "One two three go", "Los dos están at home (at) last", "", "a @ b", "Look at example.com for it", "He stared at the dot in the corner", "We met at noon. It was fine", "un dos tres", "Das ist an dem Punkt so", "1 dot 2 dot 3", "version 300 dot 1 dot 2 dot 3", "We met at polka dot dresses", "a score of 3 point 5 to 4 point 2 in 10 games", "+1 dot 2"])
def test_prose_is_left_alone(text):
    assert pii.find(text) == ([], [])


def test_base_spans_stay():
    r = random.Random(5)
    parts = ["a@b.co", " at ", " dot ", "com", "1.2.3.4", "five ", "two ", "one ", "+1 (555) 555-1234", "e​x", "о", "[at]", " x"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        base, spans = pii.find(t)
        assert set(base) <= set(spans) and all(0 <= s < e <= len(t) for _, s, e in spans)


def test_edges(spark):
    rows = pii.scan(documents(spark)).collect()
    assert len(rows) == 13 and all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
    assert pii.scan(documents(spark, [])).collect() == []
    row = pii.scan(documents(spark, [(1, "é a@b.co 1.2.3.4", "en", "s")])).first()
    assert row["spans"] == "email:2:8,ip:9:16" and row["n_email"] == row["n_ip"] == 1


def test_long_inputs_stay_linear():
    for t in ("1" * 300_000, "+1 " * 100_000, "a@" * 100_000, "a" * 300_000 + "@", "one " * 100_000, "[at] " * 4_000, " dot x" * 4_000, " " * 300_000 + "(dot)", "a.a" * 100_000 + " [at] ", "x at " * 50_000, "x [at] y." * 30_000, "(" * 100_000, " dot " * 50_000, "un " * 100_000):
        pii.find(t)
