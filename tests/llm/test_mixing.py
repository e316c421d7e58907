import duckdb
import pytest
from pyspark.sql import functions as F

from lumbung.llm import mixing

from .fixtures import documents, words


def taken(df):
    return {(r["doc_id"], r["source"]): r for r in df.collect()}


def test_edges(spark):
    rows = mixing.mix_sources(documents(spark)).collect()
    assert len(rows) == 13
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert sum(r["size"] for r in rows if r["doc_id"] in (4, 5, 6)) == 0
    assert mixing.mix_sources(documents(spark, [])).collect() == []


def test_targets_fill_like_water(spark):
    sizes = {"a": 10, "b": 1000, None: 50, "c": 0}
    rows = [(i, words(n, i), "en", s) for i, (s, n) in enumerate(sizes.items())]
    found = {r["source"]: r["target"] for r in mixing.mix_sources(documents(spark, rows)).collect()}
    # weights 1, 2, 3, 1 for a, b, c, null: a, c and null are capped at 30, 0 and 150, b has the rest
    assert found["a"] == 30 and found["c"] == 0 and found[None] == 150 and found["b"] == pytest.approx(880)


def test_budget_epochs_and_reruns(spark):
    docs = documents(spark, [(i, words(5 + i % 40, i), "en", f"s{i % 3}" if i % 2 else "hot") for i in range(800)])
    one, two = taken(mixing.mix_sources(docs)), taken(mixing.mix_sources(docs.repartition(7)))
    assert {k: v["taken"] for k, v in one.items()} == {k: v["taken"] for k, v in two.items()}
    for s in {k[1] for k in one}:
        own = [r for k, r in one.items() if k[1] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
        epochs = {r["taken"] // r["size"] for r in own if r["taken"] % r["size"] == 0}
        assert len(epochs) <= 2


def test_whole_documents(spark):
    docs = documents(spark, [(i, words(5 + i % 40, i), "en", f"s{i % 3}") for i in range(300)])
    rows = mixing.mix_sources(docs, whole=True).collect()
    assert all(r["taken"] % r["size"] == 0 for r in rows)
    for s in ("s0", "s1", "s2"):
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 45


def test_weights_draw_heavier_documents(spark):
    docs = documents(spark, [(i, words(10, i), "en", "a" if i % 2 else "b") for i in range(2000)])
    labels = spark.createDataFrame([(i, (i // 2) % 2) for i in range(2000)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = [r for r in mixing.mix_sources(docs, mixing.quality(labels)).collect() if r["source"] == "a"]
    good = sum(r["taken"] for r in rows if (r["doc_id"] // 2) % 2)
    assert good > 0.6 * sum(r["taken"] for r in rows)


def test_no_python(spark):
    docs = documents(spark)
    plan = mixing.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_sql(spark):
    docs = documents(spark).select("doc_id", "text", "source", "lang").filter(~F.coalesce(F.col("text"), F.lit("")).contains("\0"))
    con = duckdb.connect()
    frame = docs.toPandas().astype({"doc_id": "Int64"})
    con.register("documents", frame)
    con.sql("create view labels as select 1::bigint as doc_id, 1 as quality")
    expected = sorted(con.sql(mixing.ORACLE_SQL).fetchall(), key=str)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert sorted(map(tuple, mixing.mix_sources(docs, mixing.quality(labels)).select("doc_id", "source", "size", "source_size", "target", "taken").collect()), key=str) == expected


def test_repeated_documents(spark):
    rows = [(i, words(5 + i % 40, i), "en", f"s{i % 3}") for i in range(200)]
    rows += [(None, words(9, 900 + i), "en", "s1") for i in range(6)] + [(7, words(30, 950), "en", "s0"), (None, None, "en", None), (500, "", "en", "s2")] + [(8, words(4, 8), "en", None)] * 3
    docs = documents(spark, rows)
    decided = {}
    for r in mixing.mix_sources(docs, whole=True).collect():
        decided.setdefault((r["doc_id"], r["source"], r["size"]), []).append(r["taken"])
    expected = []
    for r in rows:
        size = len((r[1] or "").split())
        own = decided[r[0], r[3], size]
        assert len(set(own)) == 1
        expected += [(r[0], r[1], r[3])] * (own[0] // size if size else 0)
    kept = mixing.repeat_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"], r["source"]) for r in kept.collect()), key=str) == sorted(expected, key=str)
    assert any(r[0] is None for r in expected) and mixing.repeat_documents(documents(spark, [])).collect() == []


def test_one_id_in_many_rows(spark):
    rows = [(1, words(6, 1), "en", "a")] * 700 + [(i, words(6, i), "en", "b") for i in range(100)]
    found = mixing.mix_sources(documents(spark, rows)).collect()
    assert len(found) == 800
    for s in "ab":
        own = [r for r in found if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1 and all(0 <= r["taken"] <= 18 for r in own)
