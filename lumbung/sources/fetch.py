"""Requests made by tasks, over a transport that is passed in: landed tables without a driver that asks for each page.

A transport is a function from a URL to a status and a text; what it raises counts as no answer. All requests to one host are made by one task, one after the other, with an interval between them: more
tasks would ask the host more often than it likes. Answers that may pass (none, 429, 5xx) are asked for again, later each time. A task that is lost is run again by Spark and repeats its
own requests only; rows that other tasks have landed stay.

fetch() takes requests from a table of any size. requests() is a data source for those that a run is configured with, as the result pages of searches, which end with the first empty one.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.relational import free_name
from ..ship import shipped

Transport = Callable[[str], tuple[int, str | None]]


@dataclass(frozen=True)
class Manners:
    """Seconds between two requests to one host; how often a request is made again; seconds before the first time, which double."""

    interval: float = 0.25
    again: int = 3
    patience: float = 1.0


class Asker:
    """Asks by a transport, with manners. wait and now are the clock's, or a test's."""

    def __init__(self, transport: Transport, manners: Manners, wait: Callable[[float], None] = time.sleep, now: Callable[[], float] = time.monotonic) -> None:
        self.transport, self.manners, self.wait, self.now, self.last = transport, manners, wait, now, {}

    def __call__(self, url: str) -> tuple[int, str | None, int]:
        """Status (0 for no answer), text, and how many times was asked."""
        host = urlsplit(url).netloc.lower()
        for attempt in range(self.manners.again + 1):
            if attempt:
                self.wait(self.manners.patience * 2 ** (attempt - 1))
            if host in self.last and (left := self.last[host] + self.manners.interval - self.now()) > 0:
                self.wait(left)
            self.last[host] = self.now()
            try:
                status, text = self.transport(url)
            except Exception:  # noqa: BLE001  a transport fails in ways of its own
                status, text = 0, None
            if status and status != 429 and status < 500:
                break
        return status, text, attempt + 1


def fetch(asked: DataFrame, transport: Transport, manners: Manners = Manners(), *, url: str = "url", body: str = "html") -> DataFrame:  # noqa: B008  it is frozen
    """asked with status, the text (named by body) and attempts of each row's URL; columns of these names are replaced. Null URLs are not asked: status 0.

    Rows are dealt to tasks by host. Land the result (write it) before it is used twice: each use asks again.
    """
    shipped(asked.sparkSession)
    made = {"status": "int", body: "string", "attempts": "int"}
    rows = asked.drop(*made)
    host = free_name(rows, "__host")
    rows = rows.withColumn(host, F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))))
    columns = [c for c in rows.columns if c != host]
    dealt = rows.repartition(host).sortWithinPartitions(host).select(columns)
    schema = ", ".join([f"`{c}` {t}" for c, t in dealt.dtypes] + [f"`{c}` {t}" for c, t in made.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = Asker(transport, manners)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # answers are held by so many
                part = batch.slice(at, 64)
                answers = [ask(u) if u is not None else (0, None, 0) for u in part.column(columns.index(url)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array([a[i] for a in answers], k) for i, k in enumerate((pa.int32(), pa.string(), pa.int32())))], names=[*columns, *made])

    return dealt.mapInArrow(run, schema)


@dataclass
class _Host(InputPartition):
    """Sequences of URLs of one host: (number, URLs) of each."""

    sequences: list[tuple[int, list[str]]]


def requests(transport: Transport, empty: Callable[[str], bool] | None = None, manners: Manners = Manners()) -> type[DataSource]:  # noqa: B008
    """A data source to register and read with format("requests"): sequence, place, url, status, body, attempts. Option urls: a JSON list of lists of URLs.

    The URLs of a list are asked in order; if empty is given, up to the first that isn't found or whose text is empty by it, which is landed too.
    """

    class Reader(DataSourceReader):
        def __init__(self, sequences: list[list[str]]) -> None:
            self.sequences = sequences

        def partitions(self) -> list[InputPartition]:
            hosts: dict[str, list[tuple[int, list[str]]]] = {}
            for number, urls in enumerate(self.sequences):
                if urls:
                    hosts.setdefault(urlsplit(urls[0]).netloc.lower(), []).append((number, urls))
            return [_Host(s) for s in hosts.values()] or [_Host([])]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            ask = Asker(transport, manners)
            for number, urls in partition.sequences:
                for place, url in enumerate(urls):
                    status, body, attempts = ask(url)
                    yield number, place, url, status, body, attempts
                    if empty is not None and (status != 200 or empty(body or "")):
                        break

    class Requests(DataSource):
        @classmethod
        def name(cls) -> str:
            return "requests"

        def schema(self) -> str:
            return "sequence int, place int, url string, status int, body string, attempts int"

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
            return Reader(json.loads(self.options.get("urls", "[]")))

    return Requests


def land_requests(spark: SparkSession, asked: DataFrame, template: str, transport: Transport, path: str, *, by: str = "query", then: str | None = "page", empty: Callable[[str], bool] | None = None, manners: Manners = Manners()) -> DataFrame:  # noqa: B008
    """The results of a run's requests (articles.news_requests(), articles.archive_requests()), written to path: their columns with status, body and attempts.

    template: the URL, with {column} for columns of asked, which is configuration. Requests of one `by` are a sequence in the order of `then`.
    """
    shipped(spark)
    rows = sorted((r.asDict() for r in asked.collect()), key=lambda r: (str(r[by]), r[then] if then else 0))  # requests() of relational.py bounds them
    sequences: dict[str, list[dict]] = {}
    for r in rows:
        sequences.setdefault(str(r[by]), []).append(r)
    urls = [[template.format(**r) for r in s] for s in sequences.values()]
    spark.dataSource.register(requests(transport, empty, manners))
    found = spark.read.format("requests").option("urls", json.dumps(urls)).load()
    keys = [(n, place, *[r[c] for c in asked.columns]) for n, s in enumerate(sequences.values()) for place, r in enumerate(s)]
    known = spark.createDataFrame(keys, "sequence int, place int, " + ", ".join(f"`{c}` {t}" for c, t in asked.dtypes))
    found.join(F.broadcast(known), ["sequence", "place"]).select(*asked.columns, "url", "status", "body", "attempts").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
