"""The keyword queries read all of a text, tested against brute force in Python."""

import re

import duckdb
import pytest

from lumbung.functions import classify
from lumbung.plans import registry
from lumbung.sources import dom, pages

FILL = "x y z. " * 400
TEXTS = [f"{FILL}de", f"{FILL}the end of the line of", f"Title of {FILL}\n{FILL}of the and in and in", f"in\n{FILL}the", "de\n", "no keyword", "", None, "The\nla"]


def found(text, words):
    return [m for w in words for m in re.finditer(rf"\b{re.escape(w)}\b", text, re.IGNORECASE)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{out}/documents.parquet")
    pages = [(i, f"https://a.example/{i}", f"<p>a & b</p>{'x' * n}<b>end</b>") for i, n in enumerate([0, 30, 5000])]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{out}/pages.parquet")
    return out


def rows(spark, folder, name):
    return [r[1] for r in sorted(registry.QUERIES[name](spark, folder).collect())]


def test_keywords(spark, folder):
    alpha, gamma = registry.CORPUS["alpha"], registry.CORPUS["gamma"]
    expected = [None if t is None else (bool(found(t, gamma)), len(found(t, alpha)), min((m.start() + 1 for m in found(t, alpha)), default=None)) for t in TEXTS]
    assert expected[0][0] and expected[1][1] == 5 and expected[1][2] > 2060
    for k, name in enumerate(["keyword_any", "keyword_count_sum", "keyword_first_pos"]):
        assert rows(spark, folder, name) == [e and e[k] for e in expected], name


def test_labels(spark, folder):
    places = [next((n for n, words in registry.CORPUS.items() if found(t or "", words)), "none") for t in TEXTS]
    assert rows(spark, folder, "detect_location") == places and places[0] == "gamma"
    patterns = classify.compiled(registry.CORPUS)
    topics = [classify.topic_of(*(t or "").partition("\n")[::2], patterns, "none") for t in TEXTS]
    assert rows(spark, folder, "detect_disease") == topics and {"alpha", "beta", "gamma", "none"} <= set(topics)


def test_feed_bodies(spark, folder):
    bodies = {r["source"]: r["body"] for r in registry.QUERIES["feed_entries"](spark, folder).collect()}
    assert bodies == {str(r["page_id"]): r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}


def test_page_bodies(spark, tmp_path):
    """Of articles and of paragraphs that stand in for one; an article row's content is the first 2,000 characters, as its SQL has it."""
    long = [f"{n} é😀 {FILL}end" for n in range(4)]
    html = [f"<h1>Heading</h1><article><p>{long[0]}</p><div>{long[1]}</div></article>", f"<h1>Heading</h1><p>{long[2]}</p><p>short</p><p>{long[3]}</p>", "<h1>Heading</h1><article>one</article>" + " " * 200]
    spark.createDataFrame([(i, f"https://a.example/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    bodies = [long[0] + long[1], f"{long[2]} {long[3]}", "one"]
    assert rows(spark, tmp_path, "html_body") == bodies and len(bodies[0]) > 5000
    contents = {r["url"]: r["Content"] for r in registry.QUERIES["page_articles"](spark, str(tmp_path)).collect()}
    assert contents == {f"https://a.example/{i}": b[:2000].strip() for i, b in enumerate(bodies)}


def test_page_bodies_are_those_of_the_sql(spark, tmp_path):
    words = ["a &amp; b", "&lt;c&gt;", "<b>d</b>", "e\n\n f", "g  h", "&#39;é😀&#39;"]
    html = [f"<h1>Heading</h1><article><p>{''.join(words[(i * k) % 6] + ' ' for k in range(n))}</p>\n<p>end</p></article>" for i, n in enumerate([0, 1, 200, 400, 2000])]
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    expected = [b for _, b in sorted(con.execute(registry.ORACLE_SQL["html_body"]).fetchall())]
    assert rows(spark, tmp_path, "html_body") == expected and max(map(len, expected)) > 5000 and all(b.endswith("end") for b in expected)


def test_page_bodies_in_parts(spark, monkeypatch):
    """Bodies are handed on in parts of a batch: pages longer than a part, without html, without a title, of no site."""
    html = [None, "", "<p>no title</p>", *[f"<h1>Heading</h1><article>{n} {'x ' * n}end</article>" for n in (0, 3, 50, 500, 7)], None]
    df = spark.createDataFrame([(i, "b" if i == 4 else "a", h) for i, h in enumerate(html)], "page_id long, source string, html string").coalesce(1)
    read = lambda site: [(r["page_id"], r["body"]) for r in pages.extract(df, site, keep=("page_id",)).collect()]
    bodies = [(i, dom.parse(html[i]).children[1].text()) for i in range(3, 8)]
    for chars in (1, 100, pages.PART_CHARS):
        monkeypatch.setattr(pages, "PART_CHARS", chars)
        assert read(pages.Site("any")) == bodies and read({"a": pages.Site("a")}) == [b for b in bodies if b[0] != 4]
    assert pages.extract(df.limit(0), pages.Site("any"), keep=("page_id",)).collect() == []
