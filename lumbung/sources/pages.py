"""Landed pages to titles, bodies and raw dates, by each site's selectors."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import relational as rel
from ..ship import shipped
from . import dom

#: Pages of more characters and status 200 are worth parsing.
SHORTEST = 200
#: Characters of pages, about, whose bodies are held and handed on at once; a batch may have many more.
PART_CHARS = 8 << 20
_META = ("article:published_time", "datePublished", "og:published_time")
_SPACES = re.compile(r"\s+")


@dataclass(frozen=True)
class Site:
    """A source: its sitemaps, which URLs to take, and where title, body and date are."""

    name: str
    sitemaps: tuple[str, ...] = ()
    keyword_filter: str | None = None
    title: tuple[str, ...] = ("h1",)
    body: tuple[str, ...] = ("article",)
    date: tuple[str, ...] = ()
    date_attribute: str | None = None
    feeds: tuple[str, ...] = field(default=())


def usable(pages: DataFrame) -> DataFrame:
    """Pages that were found and are long enough to be one."""
    status = F.col("status") == 200 if "status" in pages.columns else F.lit(True)
    return pages.filter(status & (F.length("html") > SHORTEST))


def read_page(html: str, site: Site) -> tuple[str, str, list[str], list[str]] | None:
    """Title, whole body, raw dates of the selectors and of meta elements; None without a title.

    A title selector needs more than 5 characters, the h1 that stands in for it any. The first body selector that finds an element wins, even if that is
    empty; scripts, asides and the like are taken out of it for good, so what looks for dates or paragraphs later does not see them.
    """
    root = dom.parse(html)
    title = next((t for s in site.title if (e := dom.select_one(root, s)) and len(t := e.text().strip()) > 5), "")
    if not title:
        title = e.text().strip() if (e := dom.select_one(root, "h1")) else ""
    if not title:
        return None
    body = ""
    for selector in site.body:
        if (e := dom.select_one(root, selector)) is not None:
            e.remove(dom.REMOVED)
            body = _SPACES.sub(" ", e.text()).strip()
            break
    if not body:
        body = " ".join(t.strip() for p in dom.find_all(root, "p") if len(t := p.text()) > 60)
    found = [e for s in site.date if (e := dom.select_one(root, s)) is not None]
    raw = [e.attributes.get(site.date_attribute, "") if site.date_attribute else e.text() for e in found]
    return title, body, raw, [m.attributes.get("content", "") for name in _META if (m := dom.find_meta(root, name)) is not None]


def extract(pages: DataFrame, site: Site | Mapping[str, Site], keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """keep, title, whole body and raw_dates (selectors, then meta) of each page that has a title. Filter pages before: nothing can be pushed below this.

    site: of all pages, or by the source of each (column source); pages of other sources are left out.
    """
    schema = ", ".join(f"{c} {t}" for c, t in pages.dtypes if c in keep) + ", title string, body string, raw_dates array<string>"
    one = isinstance(site, Site)
    config = [asdict(s) | {"key": k} for k, s in ({"": site} if one else site).items()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {c["key"]: Site(**{k: tuple(v) if isinstance(v, list) else v for k, v in c.items() if k != "key"}) for c in config}
        for b in batches:
            chars = pd.Series([len(h or "") for h in b["html"]], b.index, "int64").cumsum()
            for _, part in b.groupby(chars // PART_CHARS):
                sites = [own[""]] * len(part) if one else [own.get(s) for s in part["source"]]
                found = [read_page(h, s) if h is not None and s is not None else None for h, s in zip(part["html"], sites, strict=True)]
                rows = part.loc[[f is not None for f in found], list(keep)].reset_index(drop=True)
                kept = [f for f in found if f is not None]
                if kept:  # Arrow can't make lists of a column without values
                    yield rows.assign(title=[f[0] for f in kept], body=[f[1] for f in kept], raw_dates=[f[2] + f[3] for f in kept])

    shipped(pages.sparkSession)
    columns = [*keep, "html"] + ([] if one or "source" in keep else ["source"])
    return pages.select(*columns).mapInPandas(run, schema)


def archive_lists(pages: DataFrame) -> DataFrame:
    """query, page, idx, href, dtr_ttl, link_text and date_title of each item of the result pages (query, page, status, html) of an archive search.

    Of each query the pages count up to the first that was not found, has no list, or has an empty one.
    """
    schema = "query string, page int, items array<struct<href: string, dtr_ttl: string, link_text: string, date_title: string>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"query": b["query"], "page": b["page"], "items": [read_list(h) if s == 200 and h is not None else [] for s, h in zip(b["status"], b["html"], strict=True)]})

    shipped(pages.sparkSession)
    read = pages.select("query", F.col("page").cast("int").alias("page"), "status", "html").mapInPandas(run, schema)
    read = rel.until_first_empty(read.withColumn("is_empty", F.size("items") == 0))
    return read.select("query", "page", F.posexplode("items").alias("idx", "item")).select("query", "page", "idx", "item.*")


def read_list(html: str) -> list[dict]:
    """The items of a result page, links or not."""
    root = dom.parse(html)
    block = dom.select_one(root, "div.list-content")
    found = []
    for article in dom.find_all(block, "article") if block else []:
        if "list-content__item" not in article.attributes.get("class", "").split():
            continue
        link = dom.select_one(article, "a.media__link")
        span = next((s for s in dom.find_all(article, "span") if "title" in s.attributes), None)
        texts = [x.strip() for x in link.walk() if isinstance(x, str)] if link else []
        found.append({
            "href": link.attributes.get("href", "") if link else None, "dtr_ttl": link.attributes.get("dtr-ttl") if link else None,
            "link_text": "".join(texts), "date_title": span.attributes["title"] if span else None,
        })
    return found


def published(known: Column, raw_dates: Column, url: Column, as_of: str, policy: str = "reference") -> Column:
    """The known date unless it is in the future, else the first raw date that can be read, else the URL's."""
    moment = dates.instant(as_of)
    sure = F.when(known.isNotNull() & ~dates.is_future(known["instant"], moment), known)
    return F.coalesce(sure, dates.first_date(F.when(sure.isNull(), raw_dates), as_of, policy=policy), dates.date_from_url(url, moment))


def with_published(df: DataFrame, known: Column, raw_dates: Column, url: Column, name: str, as_of: str, policy: str = "reference") -> DataFrame:
    """df with a column of published(), in steps that are compiled well: dates of the usual shapes are read by expressions, in one pass over each row's texts."""
    moment = dates.instant(as_of)
    sure, first = rel.free_name(df, "__sure"), rel.free_name(df, "__shown")
    read = df.withColumn(sure, F.when(known.isNotNull() & ~dates.is_future(known["instant"], moment), known))
    read = dates.with_first_date(read, F.when(F.col(sure).isNull(), raw_dates), first, as_of, policy=policy)
    return read.withColumn(name, F.coalesce(sure, first, dates.date_from_url(url, moment))).drop(sure, first)
