"""Landed feeds and sitemaps. Requests are made outside the engine; here is what comes after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_text
from ..operators.store import settled

_ITEM = "struct<title: string, link: string, description: string, summary: string, pubDate: string, published: string, updated: string>"
_FEED = f"channel struct<item: array<{_ITEM}>>"
_URLSET = "url array<struct<loc: string, lastmod: string, news: struct<publication_date: string>>>"
_INDEX = "sitemap array<struct<loc: string>>"
#: Sitemaps of pictures and films are not followed.
SKIPPED = r"(?i)image|video|foto"


def _xml(text: Column, schema: str) -> Column:
    """A document as a struct; malformed ones give null fields, they don't fail the job. Prefixes of names are taken off tags that are read."""
    plain = F.regexp_replace(text, r"<(/?)(?:news:)(?=news|publication_date)", "<$1")
    return F.from_xml(plain, schema, {"mode": "PERMISSIVE"})


def feed_entries(feeds: DataFrame, *, skip_empty: bool = True, updated: bool = True) -> DataFrame:
    """source, entry_idx, link, title, body and raw_date of the first usable feed of each source.

    feeds: source, feed_idx, status, xml. A usable feed has status 200 and, if skip_empty, an entry. body is the summary, else the description; raw_date when it was
    published, else, if asked for, updated.
    """
    items = F.coalesce(_xml(F.col("xml"), _FEED)["channel"]["item"], F.expr(f"cast(array() as array<{_ITEM}>)"))
    parsed = feeds.filter("status = 200").select("source", "feed_idx", items.alias("items"))
    parsed = parsed.filter(F.size("items") > 0) if skip_empty else parsed
    first = F.row_number().over(Window.partitionBy("source").orderBy("feed_idx"))
    chosen = parsed.withColumn("__place", first).filter("__place = 1")
    rows = chosen.select("source", F.posexplode("items").alias("entry_idx", "e"))
    some = lambda *names: F.coalesce(*[F.when(F.col(f"e.{n}") != "", F.col(f"e.{n}")) for n in names], F.lit(""))
    return rows.select(
        "source", "entry_idx", strip_text(some("link")).alias("link"), strip_text(some("title")).alias("title"), some("summary", "description").alias("body"), some("published", "pubDate", *(["updated"] if updated else [])).alias("raw_date")
    ).filter("link <> ''")


def sitemap_urls(sitemaps: DataFrame) -> DataFrame:
    """sitemap_url, idx, loc and lastmod of each sitemap, of landed rows sitemap_url, xml.

    lastmod is the url's, else that of its news. A sitemap without <url> elements that can be read falls back to its <loc> and <lastmod> texts, paired by place.
    """
    parsed = sitemaps.withColumn("__urls", _xml(F.col("xml"), _URLSET)["url"])
    known = F.transform("__urls", lambda u: F.struct(strip_text(F.coalesce(u["loc"], F.lit(""))).alias("loc"), F.coalesce(u["lastmod"], u["news"]["publication_date"], F.lit("")).alias("lastmod")))
    texts = lambda tag: F.regexp_extract_all("xml", F.lit(rf"<{tag}>\s*(.*?)\s*</{tag}>"), F.lit(1))
    locs, mods = texts("loc"), texts("lastmod")
    paired = F.transform(locs, lambda x, i: F.struct(x.alias("loc"), F.coalesce(F.get(mods, i), F.lit("")).alias("lastmod")))
    rows = parsed.select("sitemap_url", F.posexplode(F.when(F.size("__urls") > 0, known).otherwise(paired)).alias("idx", "u"))
    return rows.select("sitemap_url", "idx", "u.loc", "u.lastmod").filter("loc <> ''")


def _children(xml: Column) -> Column:
    return F.transform(_xml(xml, _INDEX)["sitemap"], lambda s: strip_text(s["loc"]))


def is_index(xml: Column) -> Column:
    """Whether a sitemap lists other sitemaps; what else it has does not count then."""
    return F.coalesce(F.size(_children(xml)) > 0, F.lit(False))


def sitemap_trees(sitemaps: DataFrame, roots: DataFrame) -> DataFrame:
    """source, sitemap_url and path of all landed sitemaps that are reached from each source's roots (source, sitemap_url, place), each once, with its least path.

    A path is an array: the root's place, then the place of each sitemap in the index before it. In the order of paths sitemaps come as one meets them who reads each index from top to
    bottom, going down before going on. Levels are joined one by one, each with what is new or got a lesser path, until there is nothing: any depth is
    reached, and a cycle ends, for a way round it only makes a path longer. Sitemaps of pictures and films are not followed. A level is settled before the next, so plans stay small.
    """
    listed = sitemaps.select(F.col("sitemap_url").alias("parent"), F.posexplode(_children(F.col("xml"))).alias("place", "child")).filter(~F.col("child").rlike(SKIPPED))
    edges = settled(listed.groupBy("parent", "child").agg(F.min("place").cast("long").alias("place")))
    least = lambda rows: rows.groupBy("source", "sitemap_url").agg(F.min("path").alias("path"))
    level = settled(least(roots.select("source", "sitemap_url", F.array(F.col("place").cast("long")).alias("path"))))
    found = level
    while True:
        further = least(level.join(edges, F.col("sitemap_url") == F.col("parent")).select("source", F.col("child").alias("sitemap_url"), F.concat("path", F.array("place")).alias("path")))
        known = found.withColumnRenamed("path", "known")
        level = settled(further.join(known, ["source", "sitemap_url"], "left").filter("known is null or path < known").drop("known"))
        if level.isEmpty():
            break
        found = settled(least(found.union(level)))
    return found.join(sitemaps.select("sitemap_url").distinct(), "sitemap_url", "left_semi").select("source", "sitemap_url", "path")


def sitemap_tree(sitemaps: DataFrame, roots: list[str]) -> DataFrame:
    """sitemap_url and path of all landed sitemaps that are reached from roots through indexes."""
    start = sitemaps.sparkSession.createDataFrame([("", r, i) for i, r in enumerate(roots)], "source string, sitemap_url string, place long")
    return sitemap_trees(sitemaps, start).drop("source")


def archive_items(items: DataFrame) -> DataFrame:
    """Items of an archive search that have a link and a title; link and title are stripped.

    items: query, page, idx, href, dtr_ttl, link_text, date_title; the title is dtr_ttl, else the link's text.
    """
    title = F.coalesce(F.when(F.col("dtr_ttl") != "", F.col("dtr_ttl")), F.col("link_text"), F.lit(""))
    rows = items.select("query", "page", "idx", strip_text(F.coalesce("href", F.lit(""))).alias("url"), strip_text(title).alias("title"), F.col("date_title").alias("raw_date"))
    return rows.filter("url <> '' and title <> ''")
