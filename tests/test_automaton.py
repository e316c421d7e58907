import random
import re
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lumbung.functions import automaton, classify
from lumbung.functions.topics import TOPICS
from lumbung.plans import articles


def brute(keywords, texts):
    found = []
    for t, text in enumerate(texts):
        for k, word in enumerate(keywords):
            found += [(t, k, m.start()) for m in re.finditer(rf"\b{re.escape(word)}\b", text or "", re.IGNORECASE)]
    return sorted(found, key=lambda x: (x[0], x[2], x[1]))


def test_against_patterns(monkeypatch):
    r = random.Random(1)
    for piece in (automaton.PIECE, 7):
        monkeypatch.setattr(automaton, "PIECE", piece)
        for _ in range(60):
            keywords = sorted({"".join(r.choice("abÄé ") for _ in range(r.randint(1, 6))).strip() or "a" for _ in range(r.randint(1, 12))} | {"a a", "b-a"})
            texts = ["".join(r.choice("abAäÉ  -_.1") for _ in range(r.randint(0, 60))) for _ in range(8)] + [None, ""]
            found = automaton.Automaton(keywords).find(texts)
            assert list(zip(*(x.tolist() for x in found), strict=True)) == brute([k.lower() for k in keywords], texts), (keywords, texts)


def test_no_keywords_and_bounds(monkeypatch):
    assert [len(x) for x in automaton.Automaton([]).find(["a"])] == [0, 0, 0] and [len(x) for x in automaton.Automaton(["a"]).find([])] == [0, 0, 0]
    with pytest.raises(ValueError, match="empty"):
        automaton.Automaton([""])
    monkeypatch.setattr(automaton, "TABLE_BYTES", 100)
    with pytest.raises(ValueError, match="part the lexicon"):
        automaton.Automaton(["abcdefgh" * 20])


def labelled(lexicon, rows):
    compiled = classify.compiled(lexicon)
    return [classify.topic_of(title or "", content, compiled, "-") for title, content in rows]


def test_labels_are_those_of_the_rule(spark):
    r = random.Random(2)
    words = ["covid", "covid-19", "corona", "flu", "flu burung", "dbd", "demam", "demam berdarah", "kanker", "x"]
    lexicon = {"a": ["covid", "covid-19"], "b": ["corona", "flu burung", "x"], "c": ["flu", "demam"], "d": ["demam berdarah", "dbd", "covid"]}
    rows = [(" ".join(r.choice(words) for _ in range(r.randint(0, 5))).title(), None if r.random() < 0.1 else ", ".join(r.choice(words) for _ in range(r.randint(0, 30)))) for _ in range(400)]
    labels = classify.Labels(lexicon)
    assert [x or "-" for x in labels.topics(*map(list, zip(*rows, strict=True)))] == labelled(lexicon, rows)
    table = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i long, title string, content string")
    both = table.select("i", classify.label_topic(F.col("title"), F.col("content"), lexicon, "-").alias("x"), classify.label_topic_large(spark, F.col("title"), F.col("content"), lexicon, "-").alias("y"),
        classify.label_place(F.concat_ws(" ", "title", "content"), lexicon, "-").alias("p"), classify.label_place_large(spark, F.concat_ws(" ", "title", "content"), lexicon, "-").alias("q"))
    assert all(row["x"] == row["y"] and row["p"] == row["q"] for row in both.collect())


def test_fifty_thousand_keywords(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    try:
        texts = pq.read_table(path).column("text").to_pylist()
    except FileNotFoundError:
        pytest.skip("no such table")
    r = random.Random(3)
    found: set[str] = set()
    for text in texts:
        words = re.findall(r"\w+ \w+|\w+", text.lower())
        found |= set(words)
    known = sorted(w for w in found if re.fullmatch(r"\w+( \w+)?", w))
    keywords = known[:: max(1, len(known) // 50_000)][:50_000]
    r.shuffle(keywords)
    lexicon = {f"c{i}": keywords[i * 10 : i * 10 + 10] for i in range(len(keywords) // 10)}
    rows = [(t[:80], t[80:]) for t in texts[:200]]
    began = time.time()
    labels = classify.Labels(lexicon)
    got = [x or "-" for x in labels.topics(*map(list, zip(*rows, strict=True)))]
    assert time.time() - began < 60 and len(keywords) > 20_000
    # by the rule, over the keywords that a text can have at all
    owners = {k: c for c, ks in lexicon.items() for k in ks}
    for (title, content), label in list(zip(rows, got, strict=True))[:60]:
        near = {k for n in (1, 2) for ws in [re.findall(r"\w+", title.lower())] for k in (" ".join(ws[i : i + n]) for i in range(len(ws))) if k in owners}
        mine = {c: [k for k in ks] for c, ks in lexicon.items() if c in {owners[k] for k in near}}
        assert label == labelled(mine, [(title, content)])[0]
    plan = lambda lex: spark.createDataFrame([("a", "b")], "t string, c string").select(classify.label_topic_large(spark, F.col("t"), F.col("c"), lex, "-").alias("x"))._jdf.queryExecution().toString()
    assert abs(len(plan(lexicon)) - len(plan({"a": ["b"]}))) < 200


def test_articles_with_a_large_lexicon(spark, monkeypatch):
    items = spark.createDataFrame([(1, "S", "Kasus malaria naik di Bali", "nyamuk malaria demam", "u1", None), (2, "S", "Demam dan malaria", "demam demam", "u2", None), (3, "S", "x", None, "u3", None)], "seq long, source string, title string, content string, url string, pub struct<instant: timestamp, local: timestamp_ntz>")
    context = articles.Context("2026-11-26T12:00:00", topics=TOPICS)
    plain = [tuple(r) for r in articles.make_rows(items, context).orderBy("seq").collect()]
    monkeypatch.setattr(articles, "EXPRESSED", 0)
    assert [tuple(r) for r in articles.make_rows(items, context).orderBy("seq").collect()] == plain
