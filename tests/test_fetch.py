"""Requests by tasks, without a network: transports that serve made-up pages."""

import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from lumbung.plans import articles, phases
from lumbung.sources import fetch, pages

FAST = fetch.Manners(interval=0, again=2, patience=0)
ROOT = Path(__file__).parents[1]


def serve(url):
    if "boom" in url:
        raise TimeoutError(url)
    return (404, None) if "gone" in url else (503, "busy") if "busy" in url else (200, f"<h1>{url}</h1>")


def test_rows_of_any_table(spark):
    rows = [("https://a.id/1", 1, "old"), ("https://b.id/gone", 2, None), ("https://a.id/busy", 3, None), ("https://c.id/boom", 4, None), (None, 5, None), ("nonsense", 6, None)]
    found = {r["n"]: r for r in fetch.fetch(spark.createDataFrame(rows, "url string, n int, html string"), serve, FAST).collect()}
    assert {n: (r["status"], r["html"], r["attempts"]) for n, r in found.items()} == {
        1: (200, "<h1>https://a.id/1</h1>", 1), 2: (404, None, 1), 3: (503, "busy", 3), 4: (0, None, 3), 5: (0, None, 0), 6: (200, "<h1>nonsense</h1>", 1),
    }
    many = spark.range(300).select(F.concat(F.lit("https://h"), (F.col("id") % 7).cast("string"), F.lit(".id/"), F.col("id").cast("string")).alias("url"))
    asked = fetch.fetch(many, serve, FAST).withColumn("part", F.spark_partition_id())
    hosts = asked.groupBy(F.regexp_extract("url", "//([^/]*)", 1).alias("h")).agg(F.countDistinct("part").alias("parts"), F.count(F.lit(1)).alias("n")).collect()
    assert len(hosts) == 7 and all(h["parts"] == 1 for h in hosts) and sum(h["n"] for h in hosts) == 300


def test_manners():
    clock, waits = [0.0], []

    def wait(seconds):
        waits.append(seconds)
        clock[0] += seconds

    ask = fetch.Asker(serve, fetch.Manners(interval=2, again=2, patience=8), wait, lambda: clock[0])
    assert ask("https://a.id/1")[0] == 200 and ask("https://a.id/2")[0] == 200 and ask("https://b.id/1")[0] == 200
    assert waits == [2.0]
    assert ask("https://b.id/busy") == (503, "busy", 3) and waits == [2.0, 2.0, 8, 16]


def test_sequences_end_with_the_first_empty_page(spark, tmp_path):
    item = '<div class="list-content"><article class="list-content__item"><a class="media__link" href="{}" dtr-ttl="Flu di Bali">t</a><span title="2 Jan 2026">x</span></article></div>'

    def search(url):
        query, page = url.split("q=")[1].split("&p=")
        return 200, item.format(f"https://x.id/{query}/{page}") if int(page) <= 2 and query != "rabies" else "<p>none"

    context = articles.Context("2026-11-26T12:00:00", topics={"Flu": ["flu"]}, places={"Bali": ["bali"]})
    asked = articles.archive_requests(spark.createDataFrame([("dbd",), ("rabies",)], "query string"), context, pages=5)
    landed = fetch.land_requests(spark, asked, "https://search.id/?q={encoded}&p={page}", search, str(tmp_path / "archive"), empty=lambda html: not pages.read_list(html), manners=FAST)
    assert sorted((r["query"], r["page"]) for r in landed.collect()) == [("dbd", 1), ("dbd", 2), ("dbd", 3), ("rabies", 1)]
    archive = landed.select("query", "page", "status", F.col("body").alias("html"))
    urls = spark.createDataFrame([("https://x.id/dbd/1",), ("https://x.id/dbd/2",)], "url string")
    read = fetch.fetch(urls, lambda url: (200, "<!--" + "x" * 200 + f"--><h1>Flu di Bali</h1><article>{url}</article>"), FAST)
    found = phases.accepted(phases.Landed(archive=archive, pages=read), context, phases.Asked(archive=("dbd",))).collect()
    assert {r["url"]: (r["Penyakit"], r["Lokasi"]) for r in found} == {"https://x.id/dbd/1": ("Flu", "Bali"), "https://x.id/dbd/2": ("Flu", "Bali")}


SCRIPT = '''
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from pyspark import TaskContext
from lumbung.sources import fetch
def serve(url):
    with open({log!r}, "a") as f:
        f.write(url + chr(10))
    if url.endswith("b.id/2") and TaskContext.get().attemptNumber() == 0:
        import os
        os._exit(1)  # the worker is lost
    return 200, url
urls = [["https://a.id/1", "https://a.id/2"], ["https://b.id/1", "https://b.id/2", "https://b.id/3"]]
import json
spark.dataSource.register(fetch.requests(serve, None, fetch.Manners(0, 0, 0)))
print("ROWS", spark.read.format("requests").option("urls", json.dumps(urls)).load().count())
spark.stop()
'''


def test_a_lost_task_repeats_its_own_requests(tmp_path):
    log = tmp_path / "log"
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT), log=str(log))], capture_output=True, text=True, timeout=300, check=False)
    assert "ROWS 5" in done.stdout, done.stderr[-2000:]
    asked = log.read_text().split()
    assert {u: asked.count(u) for u in set(asked)} == {"https://a.id/1": 1, "https://a.id/2": 1, "https://b.id/1": 2, "https://b.id/2": 2, "https://b.id/3": 1}
