"""Runs that are broken off and go on, and upserts that fail on the way."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lumbung.plans import articles, phases
from lumbung.sources import runs
from lumbung.streaming import upsert as up

RSS = "<rss><channel>{}</channel></rss>"
ITEM = "<item><title>{}</title><link>{}</link><description>a</description><pubDate>{}</pubDate></item>"
SCHEMA = "url string, seq long, v string"


def feeds(spark, rows):
    return phases.Landed(feeds=spark.createDataFrame([("Detik Health", 0, 200, RSS.format("".join(ITEM.format(*r) for r in rows)))], "source string, feed_idx int, status int, xml string"))


def urls(found):
    return sorted(r["url"] for r in found[0].collect())


def test_another_context_or_input_is_another_run(spark, tmp_path):
    folder = str(tmp_path / "run")
    landed = feeds(spark, [("flu", "u1", "3 Mei 2026"), ("flu", "u2", "3 Mei 2019")])
    now, then = (articles.Context("2026-11-26T12:00:00", years=(y,)) for y in (2026, 2019))
    assert urls(phases.full(landed, now, [], folder=folder)) == ["u1"]
    assert urls(phases.full(landed, then, [], folder=folder)) == ["u2"]
    assert urls(phases.full(feeds(spark, [("flu", "u3", "3 Mei 2026")]), now, [], folder=folder)) == ["u3"]
    other = articles.Context("2026-11-26T12:00:00", years=(2026,), topics={"x": ["flu"]}, default_topic="-")
    assert {r["Penyakit"] for r in phases.full(landed, other, [], folder=folder)[0].collect()} == {"x"}
    assert runs.phases_of(spark, folder) == {"feeds": 4}
    assert urls(phases.full(landed, now, [], folder=folder)) == ["u1"] and runs.phases_of(spark, folder) == {"feeds": 4}


def test_phases_are_made_once_and_damaged_ones_again(spark, tmp_path):
    folder, made = str(tmp_path / "p"), []
    table = spark.range(3)
    make = lambda n: lambda: (made.append(n), spark.range(n + 1))[1]

    def go(about="a", tables=(table, table)):
        run = runs.Run(spark, folder, about)
        return [run.phase(str(n), [t], make(n)).count() for n, t in enumerate(tables)]

    assert go() == [1, 2] and go() == [1, 2] and made == [0, 1]
    for f in (tmp_path / "p" / "1").glob("*/*.parquet"):
        f.write_bytes(b"junk")
    assert go() == [1, 2] and made == [0, 1, 1]
    for f in (tmp_path / "p" / "0").glob("*.json"):
        f.unlink()  # broken off before the end
    assert go() == [1, 2] and made == [0, 1, 1, 0]
    assert go("b") == [1, 2] and made[4:] == [0, 1]
    assert go("a", (table, spark.range(4))) == [1, 2] and made[6:] == [1]


def test_fingerprints(spark, tmp_path):
    path = str(tmp_path / "t p")
    spark.range(5).write.parquet(path)
    table = lambda: spark.read.parquet(path)
    one = runs.fingerprint(table())
    assert runs.fingerprint(table()) == one and runs.fingerprint(table().filter("id > 1")) != one
    spark.range(5, 6).write.mode("append").parquet(path)
    assert runs.fingerprint(table()) != one
    local = lambda rows: runs.fingerprint(spark.createDataFrame(rows, "a long, b string"))
    assert local([(1, "x"), (2, None)]) == local([(2, None), (1, "x")]) != local([(1, "x"), (2, "")])
    assert local([]) != local([(1, "x")])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def values(spark, folder):
    return {r["url"]: r["v"] for r in up.latest(spark, folder).collect()}


def stream(spark, tmp_path, checkpoint, rows, number):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{number}"))
    rows = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / f"in{number}"))
    up.upsert_stream(rows, str(tmp_path / "out"), str(tmp_path / checkpoint), buckets=3).awaitTermination()
    return values(spark, str(tmp_path / "out"))


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    assert stream(spark, tmp_path, "one", [("u1", 1, "a"), ("u2", 2, "b")], 0) == {"u1": "a", "u2": "b"}
    assert stream(spark, tmp_path, "one", [("u2", 3, "c"), ("u2", 4, "d"), ("u3", 5, "e")], 0) == {"u1": "a", "u2": "d", "u3": "e"}
    assert stream(spark, tmp_path, "two", [("d", 1, "new"), ("u1", 0, "again")], 1) == {"u1": "again", "u2": "d", "u3": "e", "d": "new"}
    assert stream(spark, tmp_path, "one", [("u9", 1, "z")], 0) == {"u1": "again", "u2": "d", "u3": "e", "d": "new", "u9": "z"}


def test_repeated_failed_and_half_written_batches(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    assert up.upsert(frame(spark, [("a", 1, "1"), ("b", 1, "1"), (None, 1, "n")]), folder, "w", 0, buckets=2)
    assert not up.upsert(frame(spark, [("a", 9, "never")]), folder, "w", 0)

    def broken(*args, **kwargs):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(up.store, "write_text", broken)
        with pytest.raises(OSError, match="no space"):
            up.upsert(frame(spark, [("a", 2, "2")]), folder, "w", 1)
    assert values(spark, folder) == {"a": "1", "b": "1", None: "n"}
    (tmp_path / "t" / "manifests" / ".00000000000000000009.json.x").write_text("half")
    (tmp_path / "t" / "data" / "half").mkdir()
    assert up.upsert(frame(spark, [("a", 2, "2")]), folder, "w", 1) and values(spark, folder) == {"a": "2", "b": "1", None: "n"}
    assert up.vacuum(spark, folder, 1) >= 2 and values(spark, folder) == {"a": "2", "b": "1", None: "n"}
    assert not up.upsert(frame(spark, []), folder, "w", 1) and up.upsert(frame(spark, []), folder, "w", 2)
    with pytest.raises(FileNotFoundError):
        up.latest(spark, str(tmp_path / "none"))


def test_what_a_batch_writes_does_not_grow_with_the_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    up.upsert(spark.range(20_000).select(F.col("id").cast("string").alias("url"), F.col("id").alias("seq"), F.lit("x" * 20).alias("v")), folder, "w", 0, buckets=4)
    sizes = []
    for k in range(1, 9):
        up.upsert(frame(spark, [(str(i * 37 % 20_000), k, f"{k}") for i in range(k, 200 + k)]), folder, "w", k)
        newest = max((tmp_path / "t" / "data").iterdir())
        sizes.append(sum(spark.read.parquet(str(newest)).count() for _ in [0]))
    assert max(sizes) < 20_000 / 4
    now = json.loads(max((tmp_path / "t" / "manifests").glob("*.json")).read_text())
    assert max(len(r) for r in now["runs"].values()) <= 8
    found = values(spark, folder)
    assert len(found) == 20_000 and found[str(8 * 37)] == "8" and found["1"] == ("x" * 20 if 1 not in {i * 37 % 20_000 for i in range(1, 208)} else found["1"])


def test_totals_follow_without_reading_rows(spark, tmp_path):
    folder = str(tmp_path / "t")
    batches = [[("a", 1, "x"), ("b", 1, "x"), ("c", 1, None)], [("a", 2, "y"), ("d", 2, "x"), ("d", 3, None)], [("c", 4, "y"), ("a", 4, "y")]]
    for epoch, rows in enumerate(batches):
        up.upsert(frame(spark, rows), folder, "w", epoch, by=["v"], buckets=2)
    assert {r["v"]: r["n"] for r in up.totals(spark, folder).collect()} == {"x": 1, "y": 2, None: 1}
    plan = up.totals(spark, folder)
    assert all("/totals/" in f for f in plan.inputFiles()) and os.path.isdir(f"{folder}/data")
