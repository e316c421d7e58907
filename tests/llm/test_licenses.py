import random

import numpy as np

from lumbung.llm import hashing, licenses

from .fixtures import documents, words

INDEX = licenses.Index()


def scan(text):
    return [(INDEX.names[m.template], m.template, m.coverage, text[s:e]) for _, m, s, e in INDEX.scan([text])]


def test_every_template_is_found_whole():
    for i, (name, text) in enumerate(licenses.TEMPLATES):
        around = f"é {words(40, i)}\n{text.upper()}\n{words(40, i + 99)}"
        found = scan(around)
        assert any(n == name and c == 1.0 for n, _, c, _ in found), (name, found)
        span = max((s for n, _, c, s in found if c == 1.0), key=len)
        assert span.lower().rstrip(".,").strip("\"/") in text.lower() + "/"


def test_edited_text_is_aligned():
    r = random.Random(2)
    for i in (3, 5, 11):
        w = licenses.TEMPLATES[i][1].split()
        for _ in range(len(w) // 20):
            k = r.randrange(len(w))
            w[k : k + 1] = r.choice([[], ["edited"], ["two", "words"]])
        found = [f for f in scan(words(100, 7) + " " + " ".join(w) + " " + words(100, 8)) if f[1] == i]
        assert len(found) == 1 and 0.8 <= found[0][2] < 1


def test_repeats_and_clean_texts():
    notice = licenses.TEMPLATES[0][1]
    assert [c for *_, c, _ in scan(notice * 3)] == [1.0] * 3
    assert scan("The license of the city permits redistribution and use in parks. " + words(500, 3)) == []


def test_winnowing_guarantee():
    r = random.Random(5)
    for _ in range(200):
        run = [f"r{r.random()}" for _ in range(licenses.K + licenses.WINDOW - 1)]
        texts = [" ".join([f"x{r.random()}" for _ in range(r.randint(0, 9))] + run + [f"y{r.random()}" for _ in range(r.randint(0, 9))]).replace(".", "") for _ in range(2)]
        sets = []
        for t in texts:
            g, _ = licenses.grams(hashing.words([t], hashing.PLAIN).hashes)
            sets.append(set(g[licenses.fingerprints(g, np.zeros(len(g)))].tolist()))
        assert sets[0] & sets[1]


def test_edges(spark):
    docs = documents(spark)
    assert licenses.scan(docs).collect() == [] and licenses.scan(documents(spark, [])).collect() == []
    text = words(25_000, 1) + " Released under the MIT License. " + words(5, 2)
    rows = licenses.scan(documents(spark, [(1, text, "en", "s"), (1, text, "en", "s"), (None, "Licensed under CC BY 4.0.", None, None)])).collect()
    assert len(rows) == 3 and all(r["coverage"] == 1.0 for r in rows)
    assert [text[r["start"] : r["end"]] for r in rows if r["doc_id"] == 1] == ["Released under the MIT License"] * 2


def changed(text, r, share):
    """A template with some words replaced, left out or put in."""
    out = []
    for w in text.split():
        x = r.random()
        out += [] if x < share / 3 else [f"q{r.randrange(99)}"] if x < 2 * share / 3 else [w, f"q{r.randrange(99)}"] if x < share else [w]
    return " ".join(out)


def test_recall_against_full_alignment():
    """Every template aligned with the whole text, without index and band."""
    r, index = random.Random(4), licenses.Index()
    expected = found = 0
    for k in range(60):
        name, template = licenses.TEMPLATES[k % len(licenses.TEMPLATES)]
        text = words(r.randint(0, 40), k) + " " + changed(template, r, r.choice([0, 0.1, 0.2])) + " " + words(r.randint(0, 40), 900 + k)
        h = hashing.words([text], hashing.PLAIN).hashes
        every = [m for t, w in enumerate(index.words) if (m := licenses.align(w, h, 0, len(h) + len(w), t)) and m.coverage >= licenses.COVERAGE]
        want = {(m.template, m.matched) for m in licenses.outer(every)}
        got = {(m.template, m.matched) for _, m, _, _ in index.scan([text])}
        expected += len(want)
        found += len(want & got)
        assert {t for t, _ in got} <= {m.template for m in every}
    assert expected > 40 and found / expected >= 0.9, (found, expected)


def test_recall_by_length_of_the_template():
    """Texts with changed words that still have 80 % of a template, of short and of long ones."""
    r, index = random.Random(8), licenses.Index()
    counts = {}
    for k in range(600):
        i = k % len(licenses.TEMPLATES)
        words_ = licenses.TEMPLATES[i][1].split()
        for j in r.sample(range(len(words_)), r.randint(0, len(words_) // 5)):
            words_[j] = f"q{r.randrange(99)}"
        text = f"{words(9, k)} {' '.join(words_)} {words(9, 700 + k)}"
        full = licenses.align(index.words[i], hashing.words([text], hashing.PLAIN).hashes, 0, 400 + len(words_), i)
        if full.coverage >= licenses.COVERAGE:
            length = min(3, len(index.words[i]) // 6)
            seen, of = counts.get(length, (0, 0))
            counts[length] = seen + any(index.names[m.template] == index.names[i] for _, m, _, _ in index.scan([text])), of + 1
    assert len(counts) == 4 and all(of > 30 and seen / of >= 0.97 for seen, of in counts.values()), counts


def test_touching_notices_are_both_reported():
    text = "Licensed under the MIT License. Licensed under the Apache License, Version 2.0. All rights reserved."
    found = [licenses.Index().names[m.template] for _, m, _, _ in licenses.Index().scan([text])]
    assert found == ["MIT", "Apache-2.0", "all-rights-reserved"]
