"""Configuration of news sites: sitemaps, URL filters, selectors and feeds."""

from __future__ import annotations

from .pages import Site

# The sites' addresses and selectors.
SITES = [
    Site("Merdeka Sehat", ("https://www.merdeka.com/sitemap.xml",), r"merdeka\.com/sehat/", ("h1.article-title", "h1.title", "h1"), (".article-content", ".content-detail", "article"), ("time", ".article-date", "[class*='date']")),
    Site("Suara Health", ("https://www.suara.com/sitemap.xml", "https://www.suara.com/health/sitemap-web.xml", "https://www.suara.com/health/sitemap-news.xml"), r"suara\.com/health/", ("h1.article__title", "h1.detail-title", "h1"), (".article__body", ".detail-news__body", "article"), ("time", "[class*='date']", "[class*='time']"), "datetime"),
    Site("Tempo Kesehatan", ("https://www.tempo.co/sitemap.xml",), r"tempo\.co/(gaya|kesehatan|health|topik)", ("h1.title", "h1.detail-title", "h1.judul", "h1"), (".detail-konten", ".artikel", ".content-detail", "article"), ("time", ".detail__footer-date", "[class*='date']"), "datetime"),
    Site("Okezone Health", ("https://health.okezone.com/sitemap.xml",), r"okezone\.com/read/\d{4}/\d{2}/\d{2}/", ("h1.title-artikel", "h1.detail-title", "h1"), ("#contentx", ".detail-news", "article"), ("time", ".post-date", "[class*='date']")),
    Site("Detik Health", ("https://health.detik.com/sitemap.xml",), r"health\.detik\.com/", ("h1.detail__title", "h1.title", "h1"), (".detail__body-text", ".detail__body", "article"), (".detail__date", "time", "[class*='date']"), None, ("https://health.detik.com/rss", "https://rss.detik.com/index.php/detikhealth")),
    Site("CNN Indonesia", ("https://www.cnnindonesia.com/sitemap.xml",), r"cnnindonesia\.com/gaya-hidup/", ("h1.title", "h1.detail-title", "h1"), (".detail-wrap .content", ".detail-text", "article"), (".update-date", "time", "[class*='date']")),
    Site("Liputan6 Kesehatan", ("https://kesehatan.liputan6.com/sitemap.xml", "https://kesehatan.liputan6.com/info-sehat/sitemap.xml", "https://kesehatan.liputan6.com/ibu-dan-anak/sitemap.xml"), r"liputan6\.com/.+/read/\d+/", ("h1.read-page--header--title", "h1.article-title", "h1"), (".article-content-body__item-content", ".article-content-body", "article"), (".read-page--header--author__datetime", "time", "[class*='date']")),
    Site("Kompas Health", ("https://health.kompas.com/sitemap.xml", "https://www.kompas.com/sitemap.xml"), r"(health\.kompas\.com/|kompas\.com/sains/)", ("h1.read__title", "h1.article__title", "h1"), (".read__content", ".article__body", "article"), (".read__time", "time", "[class*='date']"), None, ("https://health.kompas.com/rss",)),
]

# Feeds of sources that have no sitemap here.
FEEDS = {
    "Republika Kesehatan": ("https://www.republika.co.id/rss/nasional/kesehatan",),
    "Tribun Kesehatan": ("https://www.tribunnews.com/rss/kesehatan",),
    "Antara Kesehatan": ("https://www.antaranews.com/rss/kesehatan",),
    "Medcom Kesehatan": ("https://www.medcom.id/rss/kesehatan",),
}

# The archive search's name as a source, with the selectors of its pages.
ARCHIVE = Site("Detik (archive search)", (), None, ("h1.detail__title", "h1.title", "h1"), (".detail__body-text", ".detail__body", "article"), (".detail__date", "time", "[class*='date']"))

# The order in which sources' feeds are read.
FEED_ORDER = ("Detik Health", "Republika Kesehatan", "Tribun Kesehatan", "Antara Kesehatan", "Medcom Kesehatan", "Kompas Health")
