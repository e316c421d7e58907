"""Article tables: rows from titles and texts, the full run and the weekly update."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, dates, text
from ..functions.lexicon import DEFAULT_PLACE, DEFAULT_TOPIC, PROVINCES, Lexicon
from ..functions.topics import TOPICS
from ..operators import relational as rel
from ..sources.searches import ARCHIVE_PAGES, NEWS_QUERIES


#: Keywords up to which a lexicon is an expression in the plan; larger ones are an automaton, with the same labels.
EXPRESSED = 1000


@dataclass(frozen=True)
class Context:
    """What a run depends on: the time it is made at, the years it is for and the lexicons.

    most: rows from which no more top-up is made; news_cap: rows of the news search.
    """

    as_of: str
    years: tuple[int, ...] = (2025, 2026)
    policy: str = "reference"
    topics: Lexicon = field(default_factory=lambda: TOPICS)
    places: Lexicon = field(default_factory=lambda: PROVINCES)
    default_topic: str = DEFAULT_TOPIC
    default_place: str = DEFAULT_PLACE
    most: int = 10_000
    news_cap: int = 3_000

    @property
    def now(self):  # noqa: ANN201
        return dates.instant(self.as_of)


def with_content(found: DataFrame) -> DataFrame:
    """Extracted pages with an article's content in place of the body, which is whole: what follows, checkpoints too, need not carry the rest."""
    return found.withColumn("content", text.truncate(F.col("body"))).drop("body")


def make_rows(items: DataFrame, context: Context) -> DataFrame:
    """Article rows of items: source, title, content, url and pub (instant and local, may be null); phase, batch and seq stay.

    Labels are made of the texts before they are stripped; content is at most 2,000 characters before and after. Future dates count as none.
    """
    pub = F.when(~dates.is_future(F.col("pub.instant"), context.now), F.col("pub"))
    kept = [c for c in ("phase", "batch", "seq") if c in items.columns]
    ready = items.withColumn("__pub", pub).withColumn("__content", text.truncate(F.coalesce("content", F.lit(""))))
    fields = dates.week_fields(F.col("__pub.local"))
    both, title, content = F.concat_ws(" ", "title", "__content"), F.col("title"), F.col("__content")
    large = lambda lexicon: sum(map(len, lexicon.values())) > EXPRESSED
    place = classify.label_place_large(items.sparkSession, both, context.places, context.default_place) if large(context.places) else classify.label_place(both, context.places, context.default_place)
    topic = classify.label_topic_large(items.sparkSession, title, content, context.topics, context.default_topic) if large(context.topics) else classify.label_topic(title, content, context.topics, context.default_topic)
    return ready.select(
        *kept, text.url_id(F.col("url")).alias("id"), F.col("source").alias("Source"), text.strip_text(F.col("title")).alias("Title"), text.truncate(text.strip_text(F.col("__content"))).alias("Content"), "url",
        *[c.alias(n) for n, c in fields.items()], topic.alias("Penyakit"), place.alias("Lokasi"),
    )


def full_run(phases: Sequence[DataFrame], context: Context, top_up: Callable[[], DataFrame] | None = None, news_phase: int = 1) -> tuple[DataFrame, DataFrame]:
    """The numbered clean rows and the rows that the audit took out.

    phases: article rows with seq, in order of precedence. Each is filtered by year before they meet, so a row that is rejected does not stand in
    the way of the same url in a later phase. The news phase is capped after what earlier phases have. top_up is asked for only if there are too few rows.
    """
    together: DataFrame | None = None
    for number, rows in enumerate(phases):
        fresh = rel.year_filter(rows, context.years).withColumn("phase", F.lit(number))
        if number == news_phase:
            fresh = rel.keep_first(fresh, "id", ["seq"])
            fresh = rel.anti_seen(fresh, together) if together is not None else fresh
            fresh = rel.first_rows(fresh, context.news_cap, ["seq"])
        together = fresh if together is None else together.unionByName(fresh)
    unique = rel.keep_first(together, "id", ["phase", "seq"])
    if top_up is not None and unique.count() < context.most:
        more = rel.year_filter(top_up(), context.years).withColumn("phase", F.lit(len(phases)))
        unique = rel.keep_first(together.unionByName(more), "id", ["phase", "seq"])
    return finalize(unique, context, ["phase", "seq"])


def finalize(unique: DataFrame, context: Context, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Sorted, numbered, public columns, then audited: numbers may have gaps."""
    numbered = rel.public_columns(rel.number_rows(unique, rel.newest_first(order)))
    return rel.audit(numbered, context.now)


def weekly_update(existing: DataFrame, new: DataFrame, context: Context) -> DataFrame:
    """existing with new rows of the week, which replace those of the same url.

    existing keeps its order (No); new has seq. Without a new row existing is returned as it is.
    """
    fresh = new.filter(dates.row_in_week(context.now))
    if fresh.isEmpty():
        return existing
    old = existing.withColumn("seq", F.col("No").cast("long")).drop("No")
    side = rel.free_name(old, rel.free_name(fresh, "__source"))
    merged = rel.merge_by_url(old, fresh.drop("id", "phase"), side=side)
    return finalize(merged, context, [side, "seq"])[0]


def week_candidates(urls: DataFrame, context: Context) -> DataFrame:
    """Sitemap candidates (known, a struct of instant and local) whose date is not known or in the week."""
    return urls.filter(F.col("known").isNull() | dates.in_week(F.col("known.instant"), context.now))


def known_week(existing: DataFrame, context: Context) -> int:
    """Rows that existing has of as_of's week."""
    return existing.filter(F.col("Week_Label") == dates.week_label(context.now)).count()


def search_queries(spark: SparkSession, queries: Sequence[str] = NEWS_QUERIES) -> DataFrame:
    """A row for each query, with its place."""
    return spark.createDataFrame(list(enumerate(queries)), "place int, query string")


def _requested(asked: DataFrame) -> DataFrame:
    # dates as texts: format_string() would give numbers of days
    request = F.concat_ws("", "query", F.lit(" after:"), F.col("month_start").cast("string"), F.lit(" before:"), F.col("month_end").cast("string"))
    return asked.withColumn("request", request).withColumn("encoded", text.quote_query(F.col("request")))


def news_requests(queries: DataFrame, context: Context, months: int = 3) -> DataFrame:
    """A row for each query and month to ask for, with the text of the request."""
    return _requested(rel.requests(queries, dates.last_months(queries.sparkSession, context.as_of, months)))


def week_news_requests(queries: DataFrame, context: Context) -> DataFrame:
    """A row for each query, for as_of's week: from its Monday until before the next."""
    monday = F.date_trunc("week", context.now).cast("date")
    return _requested(queries.withColumn("month_start", monday).withColumn("month_end", F.date_add(monday, 7)))


def archive_requests(queries: DataFrame, context: Context, pages: int = ARCHIVE_PAGES) -> DataFrame:
    """A row for each query and result page, with the days between which to search: from the first year's first day to as_of's."""
    numbers = queries.sparkSession.range(1, pages + 1).select(F.col("id").cast("int").alias("page"))
    first = F.lit(f"01/01/{min(context.years)}")
    return rel.requests(queries, numbers).withColumn("encoded", text.quote_query(F.col("query"))).withColumn("from", first).withColumn("to", F.date_format(context.now, "dd/MM/yyyy"))


def publish(df: DataFrame, send: Callable[[DataFrame, str], None], token: str | None, target: str, as_of: dt.datetime | str) -> bool:
    """Hands the table and a commit message to send; without a token or a real target it does nothing and says so."""
    if not token or not target or target.startswith("your-"):
        return False
    label = df.sparkSession.range(1).select(dates.commit_label(dates.instant(as_of))).first()[0]
    send(df, f"Weekly update {label}: +{df.count()} total rows")
    return True
