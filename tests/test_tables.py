import pytest
from pyspark.sql import functions as F

from lumbung.operators import relational as rel
from lumbung.plans import articles
from lumbung.sources import dom, feeds, files, pages

CONTEXT = articles.Context("2026-11-26T12:00:00")
ITEM = "seq long, source string, title string, content string, url string, pub struct<instant: timestamp, local: timestamp_ntz>"


def items(spark, rows):
    df = spark.createDataFrame([(s, "S", t, c, u, d) for s, t, c, u, d in rows], "seq long, source string, title string, content string, url string, d string")
    pub = F.when(F.col("d").isNotNull(), F.struct(F.col("d").cast("timestamp").alias("instant"), F.col("d").cast("timestamp_ntz").alias("local")))
    return articles.make_rows(df.withColumn("pub", pub).drop("d"), CONTEXT)


def test_full_run(spark):
    first = items(spark, [(1, "flu", "a", "u1", "2024-05-01"), (2, "flu", "a", "u2", "2025-05-01"), (3, "x", "", "u9", None)])
    second = items(spark, [(1, " demam ", "b", "u1", "2025-06-01"), (2, "late", "b", "u2", "2025-07-01"), (3, "new", "b", "u3", "2026-11-01")])
    clean, bad = articles.full_run([first, second], CONTEXT)
    rows = clean.orderBy("No").collect()
    assert [(r["No"], r["url"], r["Title"]) for r in rows] == [(1, "u3", "new"), (2, "u1", "demam"), (3, "u2", "flu")]
    assert rows[1]["Penyakit"] == "Demam" and bad.count() == 0


def test_top_up_and_caps(spark):
    one = items(spark, [(i, "t", "", f"a{i}", "2025-01-01") for i in range(5)])
    two = items(spark, [(i, "t", "", f"b{i}", "2025-01-01") for i in range(9)])
    small = articles.Context("2026-11-26T12:00:00", most=10, news_cap=3)
    asked = []
    clean, _ = articles.full_run([one, two], small, lambda: asked.append(1) or two)
    assert asked and clean.count() == 5 + 9
    assert articles.full_run([one, two], articles.Context("2026-11-26T12:00:00", most=8, news_cap=3), lambda: 1 / 0)[0].count() == 8


def test_audit_leaves_gaps(spark):
    rows = spark.createDataFrame([(1, 2027, 1, 1, "2027-01-04"), (2, 2026, 11, 48, "2026-11-23"), (3, None, None, None, None), (4, 2026, 11, 49, "2026-11-30")], "seq long, Year int, Month int, Week int, Minggu_Mulai string")
    clean, bad = rel.audit(rel.number_rows(rows, rel.newest_first(["seq"])), CONTEXT.now)
    assert sorted(r["seq"] for r in bad.collect()) == [1, 4]
    assert {r["seq"]: r["No"] for r in clean.collect()} == {2: 3, 3: 4}


def test_weekly_update(spark):
    old = rel.public_columns(items(spark, [(1, "a", "", "u1", "2026-11-02"), (2, "b", "", "u2", "2026-11-03")]).withColumn("No", F.col("seq")))
    new = items(spark, [(1, "flu", "", "u2", "2026-11-25"), (2, "c", "", "u3", "2026-11-24"), (3, "d", "", "u4", "2026-11-10")])
    done = articles.weekly_update(old, new, CONTEXT)
    assert [(r["No"], r["url"], r["Title"]) for r in done.orderBy("No").collect()] == [(1, "u2", "flu"), (2, "u3", "c"), (3, "u1", "a")]
    again = articles.weekly_update(done, new, CONTEXT)
    assert sorted(map(str, again.collect())) == sorted(map(str, done.collect()))
    assert articles.weekly_update(old, new.filter("seq = 3"), CONTEXT) is old


def test_batches(spark):
    df = spark.createDataFrame([(b, i) for b, n in ((1, 4), (2, 4), (3, 4)) for i in range(n)], "batch int, i int")
    assert {r["batch"] for r in rel.cap_batches(df, "batch", 5).collect()} == {1, 2}
    assert {r["batch"] for r in rel.cap_batches(df, "batch", 5, before=9, at_least_one=True).collect()} == {1}
    found = rel.until_first_empty(spark.createDataFrame([("q", 1, False), ("q", 2, True), ("q", 3, False), ("r", 1, False)], "query string, page int, is_empty boolean"))
    assert sorted((r["query"], r["page"]) for r in found.collect()) == [("q", 1), ("r", 1)]


def test_numbers_are_dense_in_any_partitioning(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    for n in (1, 3, 16):
        assert all(r["No"] == r["k"] + 1 for r in rel.number_rows(df, [F.col("k")], partitions=n).collect())
    assert rel.number_rows(df.limit(0), [F.col("k")]).count() == 0


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ('<div class="title">Short</div><h1>Ok</h1>', ("Ok", "")), ("<p>no title</p>", None),
        ('<h1>Title here</h1><div class="body"></div><p>' + "x" * 61 + "</p>", ("Title here", "x" * 61)),
        ("<h1>T</h1><article><aside><p>" + "y" * 80 + "</p></aside></article>", ("T", "")),
        ("<h1>T</h1><article>a<br>b<p>c<p>d  e<script>no</script></article>", ("T", "abcd e")),
    ],
)
def test_pages(html, expected):
    site = pages.Site("s", title=(".title", "h1.none"), body=(".body", "article"), date=("time",))
    found = pages.read_page(html, site)
    assert (found and found[:2]) == expected


def test_dates_in_removed_parts_are_not_seen():
    site = pages.Site("s", date=("time", "[class*='date']"), date_attribute="datetime")
    html = '<h1>Title</h1><article>x<aside><time datetime="a"></time></aside></article><i class="my-date" datetime="b"></i><meta property="article:published_time" content="c">'
    assert pages.read_page(html, site)[2:] == (["b"], ["c"])
    assert dom.select_one(dom.parse('<div class="w"><p class="x y" id="i">t</p></div>'), ".w p.x").text() == "t"


def test_feeds_and_sitemaps(spark):
    rss = "<rss><channel>{}</channel></rss>"
    item = "<item><title> T </title><link> u </link><summary></summary><description>d</description><updated>2025</updated></item>"
    rows = [("a", 0, 404, rss.format(item)), ("a", 1, 200, rss.format("")), ("a", 2, 200, rss.format(item)), ("b", 0, 200, "broken <"), ("c", 0, 200, rss.format("<item><title>t</title></item>"))]
    df = spark.createDataFrame(rows, "source string, feed_idx int, status int, xml string")
    assert [tuple(r) for r in feeds.feed_entries(df).collect()] == [("a", 0, "u", "T", "d", "2025")]
    assert feeds.feed_entries(df, skip_empty=False).count() == 0
    maps = [("m", "<urlset><url><loc> l1 </loc><lastmod>2025</lastmod></url><url><loc>l2</loc><news:news><news:publication_date>2024</news:publication_date></news:news></url></urlset>"), ("n", "junk <loc>l3</loc> <loc>l4</loc><lastmod>x</lastmod>")]
    found = feeds.sitemap_urls(spark.createDataFrame(maps, "sitemap_url string, xml string"))
    assert sorted((r["loc"], r["lastmod"]) for r in found.collect()) == [("l1", "2025"), ("l2", "2024"), ("l3", "x"), ("l4", "")]


def test_sitemap_cycles_end(spark):
    index = "<sitemapindex>{}</sitemapindex>"
    one = lambda u: f"<sitemap><loc>{u}</loc></sitemap>"
    rows = [("a", index.format(one("b") + one("video-map"))), ("b", index.format(one("a") + one("c"))), ("c", "<urlset/>"), ("video-map", "<urlset/>")]
    found = feeds.sitemap_tree(spark.createDataFrame(rows, "sitemap_url string, xml string"), ["a"])
    assert {(r["sitemap_url"], len(r["path"]) - 1) for r in found.collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_files(spark, tmp_path):
    rows = rel.public_columns(items(spark, [(1, 'quote " and, comma\nline', "x", "u1", "2026-11-02"), (2, "b", "", "u2", None)]).withColumn("No", F.col("seq")))
    files.write_dataset(rows, str(tmp_path / "csv"))
    back = {r["url"]: r for r in files.read_dataset(spark, str(tmp_path / "csv")).collect()}
    assert back["u1"]["Title"] == 'quote " and, comma\nline' and back["u2"]["Year"] is None and back["u1"]["Year"] == 2026
    assert files.read_dataset(spark, str(tmp_path / "none")).count() == 0
    files.write_backup(rows, str(tmp_path / "b"), [2025], "now")
    assert spark.read.json(str(tmp_path / "b/about")).first()["total"] == 2


def test_registry_has_sql():
    from lumbung.plans import registry

    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES) and len(registry.QUERIES) >= 31
