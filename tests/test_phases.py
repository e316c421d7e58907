import pytest
from pyspark.sql import functions as F

from lumbung.functions import dates
from lumbung.operators import relational as rel
from lumbung.plans import articles, phases
from lumbung.sources import feeds, files, pages, runs, searches

CONTEXT = articles.Context("2026-11-26T12:00:00", most=3)
SITE = pages.Site("Sehat", ("top",), r"x\.id/sehat/", ("h1",), ("article",), ("time",), "datetime")
FILL = "<!--" + "x" * 200 + "-->"


def page(title, body="", date=""):
    return f'{FILL}<h1>{title}</h1><article>{body}</article><time datetime="{date}"></time>'


@pytest.fixture
def landed(spark):
    rss = "<rss><channel>{}</channel></rss>"
    item = "<item><title>{}</title><link>{}</link><description>a  b</description><pubDate>{}</pubDate></item>"
    rows = [("Detik", 0, 200, rss.format("")), ("Detik", 1, 200, rss.format(item.format("Kasus flu", "https://x.id/1", "Tue, 24 Nov 2026 10:00:00 +0700") + item.format("Lama", "https://x.id/0", "1 Mei 2019"))), ("Other", 0, 500, "")]
    news = [("flu", "2026-11-01", rss.format(item.format("Waspada malaria", "https://www.berita.com/a", "25 November 2026") + item.format("Ulang", "https://x.id/1", "24 Nov 2026"))), ("dbd", "2026-11-01", rss.format("<item><title>no date</title><link>https://q.id/9</link><updated>2026-11-24</updated></item>"))]
    index = "<sitemapindex>{}</sitemapindex>"
    maps = [
        ("top", index.format("<sitemap><loc>mid</loc></sitemap><sitemap><loc>image-map</loc></sitemap>")), ("mid", index.format("<sitemap><loc>leaf</loc></sitemap><sitemap><loc>top</loc></sitemap>")),
        ("leaf", "<urlset>" + "".join(f"<url><loc>{u}</loc><lastmod>{d}</lastmod></url>" for u, d in [
            ("https://x.id/sehat/a", "2026-11-25T08:00:00+07:00"), ("https://x.id/sehat/b", ""), ("https://x.id/sehat/c", "2019-01-31"), ("https://x.id/sehat/p.jpg", "2026-11-24"), ("https://x.id/nasional/demam-berdarah-naik", "2026-11-23"), ("https://x.id/2025/05/04/sehat/d", ""),
        ]) + "</urlset>"), ("image-map", "<urlset><url><loc>https://x.id/sehat/z</loc></url></urlset>"),
    ]
    read = [("https://x.id/sehat/a", 200, page("Stroke", "isi")), ("https://x.id/sehat/b", 200, page("Mpox di Bali", "isi", "3 Maret 2026")), ("https://x.id/sehat/c", 200, page("Old")), ("https://x.id/nasional/demam-berdarah-naik", 200, page("DBD naik")), ("https://x.id/sehat/z", 200, page("No")), ("https://arsip.id/1", 200, page("Rabies", date="x"))]
    result = '<div class="list-content"><article class="list-content__item"><a class="media__link" href="https://arsip.id/1" dtr-ttl="Rabies">t</a><span title="Jumat, 2 Jan 2026 09:00 WIB">x</span></article></div>'
    archive = [("rabies", 1, 200, result), ("rabies", 2, 200, "<p>none"), ("rabies", 3, 200, result.replace("arsip.id/1", "arsip.id/2"))]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    return phases.Landed(
        frame(rows, "source string, feed_idx int, status int, xml string"), frame(news, "query string, month_start string, xml string"), frame(archive, "query string, page int, status int, html string"),
        frame(maps, "sitemap_url string, xml string"), frame(read, "url string, status int, html string"),
    )


def test_full_run_with_all_phases(spark, landed, tmp_path):
    folder = str(tmp_path / "run")
    clean, bad = phases.full(landed, CONTEXT, [SITE], folder=folder)
    rows = {r["url"]: r for r in clean.collect()}
    assert {u: r["Source"] for u, r in rows.items()} == {
        "https://x.id/1": "Detik", "https://www.berita.com/a": "Berita", "https://arsip.id/1": "Detik (archive search)", "https://x.id/sehat/a": "Sehat", "https://x.id/sehat/b": "Sehat",
    }
    assert rows["https://x.id/1"]["Content"] == "a b" and rows["https://www.berita.com/a"]["Penyakit"] == "Malaria" and rows["https://x.id/sehat/b"]["Lokasi"] == "Bali"
    assert rows["https://arsip.id/1"]["Month"] == 1 and rows["https://x.id/sehat/b"]["Month"] == 3 and bad.count() == 0
    assert runs.phases_of(spark, folder) == {"feeds": 1, "news": 1, "archive": 1, "sitemaps": 1}
    again, _ = phases.full(landed, CONTEXT, [SITE], folder=folder)
    assert sorted(map(str, again.collect())) == sorted(map(str, clean.collect()))


def test_top_up(landed):
    wide = phases.full(landed, articles.Context("2026-11-26T12:00:00", most=100), [SITE])[0]
    assert {r["url"]: r["Source"] for r in wide.collect()}["https://x.id/nasional/demam-berdarah-naik"] == "Sehat (top-up)"


def test_weekly(spark, landed):
    old = spark.createDataFrame([], files.DATASET)
    found = {r["url"]: r["Source"] for r in phases.weekly(old, landed, CONTEXT, [SITE]).collect()}
    # the first Detik feed is empty, so the entry comes from the news search; b shows a date of March, the top of the list is of the week
    assert found == {"https://www.berita.com/a": "Berita", "https://x.id/1": "X.Id", "https://x.id/sehat/a": "Sehat"}


def test_nothing_landed():
    with pytest.raises(ValueError, match="landed"):
        phases.full(phases.Landed(), CONTEXT)


def test_deep_sitemaps_are_reached(spark):
    rows = [(f"m{i}", f"<sitemapindex><sitemap><loc>m{i + 1}</loc></sitemap></sitemapindex>") for i in range(9)] + [("m9", "<urlset/>")]
    found = feeds.sitemap_tree(spark.createDataFrame(rows, "sitemap_url string, xml string"), ["m0"])
    assert {r["sitemap_url"]: r["path"] for r in found.collect()} == {f"m{i}": [0] * (i + 1) for i in range(10)}


def test_requests_are_configuration(spark):
    asked = articles.news_requests(spark.createDataFrame([("dbd",)], "query string"), CONTEXT).orderBy("month_start").collect()
    assert asked[-1]["request"] == "dbd after:2026-11-01 before:2026-12-01" and len(asked) == 3
    with pytest.raises(ValueError, match="configuration"):
        rel.requests(spark.range(rel.CONFIGURED + 1), spark.range(1))


def test_published_cascade(spark):
    late = "named_struct('instant', timestamp'2099-01-01', 'local', timestamp_ntz'2099-01-01')"
    rows = spark.createDataFrame([(["x", "2 Maret 2026"], "u"), (["x"] * 9, "https://x/2025/05/04/"), ([], "u")], "raw array<string>, url string").withColumn("known", F.expr(late))
    found = rows.select(pages.published(F.col("known"), F.col("raw"), F.col("url"), CONTEXT.as_of)["local"].cast("date").cast("string")).collect()
    assert [r[0] for r in found] == ["2026-03-02", "2025-05-04", None]


def test_dataset_nulls(spark, tmp_path):
    (tmp_path / "d.csv").write_text("No,Source,Title,Year,url\n1,#N/A,n/a,2026.0,u\n2,S,<NA>,-nan,v\n")
    found = files.read_dataset(spark, str(tmp_path / "d.csv")).orderBy("No").collect()
    assert [(r["Source"], r["Title"], r["Year"]) for r in found] == [(None, None, 2026), ("S", None, None)]


def test_iso_strict_first_date(spark):
    rows = spark.createDataFrame([(["2025-03-12"],)], "raw array<string>")
    local = lambda p: rows.select(dates.first_date(F.col("raw"), CONTEXT.as_of, policy=p)["local"].cast("date").cast("string")).first()[0]
    assert (local("reference"), local("iso_strict")) == ("2025-12-03", "2025-03-12")


def test_publish(spark):
    sent = []
    rows = spark.range(3)
    assert not articles.publish(rows, lambda *a: sent.append(a), None, "team/set", CONTEXT.as_of) and not articles.publish(rows, lambda *a: sent.append(a), "t", "your-name/set", CONTEXT.as_of)
    assert articles.publish(rows, lambda df, message: sent.append((df.count(), message)), "t", "team/set", CONTEXT.as_of)
    assert sent == [(3, "Weekly update W47-2026: +3 total rows")]


def test_archive_pages_end_at_the_first_empty(spark):
    rows = [("q", 1, 200, "<div class='list-content'><article class='list-content__item'><a class='media__link' href='u'> a <b> b </b></a></article></div>"), ("q", 2, 404, None), ("q", 3, 200, "x"), ("r", 1, 200, "<p>")]
    found = pages.archive_lists(spark.createDataFrame(rows, "query string, page int, status int, html string")).collect()
    assert [(r["query"], r["page"], r["href"], r["dtr_ttl"], r["link_text"], r["date_title"]) for r in found] == [("q", 1, "u", None, "ab", None)]


def test_searches(spark):
    news = articles.search_queries(spark)
    assert news.count() == 44 and articles.news_requests(news, CONTEXT).count() == 132
    archive = articles.archive_requests(articles.search_queries(spark, searches.ARCHIVE_QUERIES), CONTEXT)
    row = archive.filter("query = 'asam urat' and page = 15").first()
    assert archive.count() == 600 and (row["encoded"], row["from"], row["to"]) == ("asam%20urat", "01/01/2025", "26/11/2026")


def test_sitemaps_are_read_as_one_meets_them(spark):
    index = "<sitemapindex>{}</sitemapindex>"
    one = lambda u: f"<sitemap><loc>{u}</loc></sitemap>"
    rows = [("r", index.format(one("a") + one("b"))), ("a", index.format(one("c") + one("b") + one("r"))), ("b", "<urlset/>"), ("c", "<urlset/>"), ("s", index.format(one("c")))]
    found = feeds.sitemap_tree(spark.createDataFrame(rows, "sitemap_url string, xml string"), ["s", "r"])
    assert {r["sitemap_url"]: r["path"] for r in found.collect()} == {"s": [0], "c": [0, 0], "r": [1], "a": [1, 0], "b": [1, 0, 1]}


def test_the_order_of_queries_is_the_configurations(spark):
    rss = "<rss><channel><item><title>flu {}</title><link>https://{}.id/</link><pubDate>24 Nov 2026</pubDate></item></channel></rss>"
    news = spark.createDataFrame([("alpha", "2026-11-01", rss.format("a", "a")), ("zeta", "2026-11-01", rss.format("z", "z")), ("other", "2026-11-01", rss.format("o", "o"))], "query string, month_start string, xml string")
    context = articles.Context("2026-11-26T12:00:00", topics={"Flu": ["flu"]}, places={"Bali": ["bali"]}, news_cap=2)
    asked = phases.Asked(news=("zeta", "alpha"))
    assert {r["url"] for r in phases.accepted(phases.Landed(news=news), context, asked).collect()} == {"https://z.id/", "https://a.id/"}
    week = phases.weekly(spark.createDataFrame([], files.DATASET), phases.Landed(news=news), context, asked=asked)
    assert {r["url"] for r in week.collect()} == {"https://z.id/", "https://a.id/"}


def test_batches_end_and_later_ones_are_not_made(spark):
    made = []

    def make(some):
        made.append(list(some))
        rows = [(f"{b}{i}" if i else "same", [int(b), i], int(b)) for b in some for i in range(3)]
        return spark.createDataFrame(rows, "id string, seq array<int>, batch int")

    names = [str(i) for i in range(20)]
    taken = rel.accept_batches(make, names, 5)
    assert sorted(r["id"] for r in taken.collect()) == ["01", "02", "11", "12", "same"] and made == [["0"], ["1", "2"]]
    assert rel.accept_batches(make, names, 4, whole=False).count() == 4
    seen = spark.createDataFrame([("same",)], "id string")
    assert sorted(r["id"] for r in rel.accept_batches(make, names, 4, seen=seen, before=9, at_least_one=True).collect()) == ["01", "02"]
    assert rel.accept_batches(make, names, 4, before=4) is None and rel.accept_batches(make, [], 4) is None


def test_queries_of_a_phase_may_be_many(spark, monkeypatch):
    monkeypatch.setattr(rel, "CONFIGURED", 3)
    rss = "<rss><channel><item><title>flu</title><link>https://{}.id/</link><pubDate>24 Nov 2026</pubDate></item></channel></rss>"
    news = spark.createDataFrame([(q, "2026-11-01", rss.format(q)) for q in ("b", "z", "a", "q", "c", "zz")] + [(None, None, rss.format("n"))], "query string, month_start string, xml string")
    rows = phases.news_phase(news, CONTEXT, queries=("zz", "not asked", "q")).orderBy("seq").collect()
    assert [(r["url"], r["batch"]) for r in rows] == [(f"https://{q}.id/", i) for i, q in enumerate(("zz", "q", "a", "b", "c", "z"))]


def test_the_cap_of_a_phase_is_that_of_a_run(spark, tmp_path):
    from lumbung.plans import registry

    n = registry.CONTEXT.news_cap
    spark.range(n + 9).selectExpr("id as doc_id", "cast(id as string) as text").write.parquet(str(tmp_path / "documents.parquet"))
    assert registry.phase_cap(spark, str(tmp_path)).count() == n and f"limit {n}" in registry.ORACLE_SQL["phase_cap"]


def test_a_top_up_is_asked_for_at_every_size(spark, tmp_path):
    """More orders of the first phase than a run takes before it tops up."""
    from lumbung.plans import registry

    n = registry.CONTEXT.most + 5
    orders = spark.range(n + 1).selectExpr("id as o_orderkey", "id as o_custkey", "timestamp_ntz'1994-03-02' as o_orderdate", "'1-URGENT' as o_orderpriority", f"if(id < {n}, 'P', 'O') as o_orderstatus")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    assert tuple(registry.topped_up(spark, str(tmp_path)).first()) == (n + 1, n + 1, n + 1)


def test_the_date_of_a_url_that_is_listed_again_is_the_earliest_if_asked_for(spark):
    one = "<url><loc>https://x.id/sehat/{}</loc><lastmod>{}</lastmod></url>"
    listed = [("a", ""), ("a", "2026-11-24"), ("a", "2026-11-20"), ("b", ""), ("c", "2026-11-25"), ("c", "2026-11-24"), ("d", "2019-01-31"), ("d", "2026-11-26")]
    maps = spark.createDataFrame([("top", "<urlset>" + "".join(one.format(*x) for x in listed) + "</urlset>")], "sitemap_url string, xml string")

    def found(**how):
        rows = phases.candidates(maps, CONTEXT, [SITE], **how).withColumn("day", F.col("known.local").cast("date").cast("string")).collect()
        return {r["url"][-1]: (r["day"], r["path"][-1]) for r in rows}

    assert found(earliest=True) == {"a": ("2026-11-20", 0), "b": (None, 3), "c": ("2026-11-24", 4), "d": ("2026-11-26", 7)}
    assert found(earliest=True, week=True) == {"b": (None, 3), "c": ("2026-11-24", 4), "d": ("2026-11-26", 7)}
    assert found() == {"a": (None, 0), "b": (None, 3), "c": ("2026-11-25", 4), "d": ("2026-11-26", 7)}
