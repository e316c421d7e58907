import importlib
import os
import re

from pyspark.sql import functions as F

import corpus_pipeline
from lumbung.llm import mixing, packing, toxicity

from . import test_jaccard, test_lines, test_packing
from .fixtures import documents


def test_stages_take_odd_rows(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (None, []):
        docs = documents(spark, rows)
        columns = docs.columns
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            out.write.parquet(path := f"{tmp_path}/{name}-{rows is None}")
            docs = spark.read.parquet(path)
            if number < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == columns, name
        assert (docs.count() > 0) == (rows is None)


def test_every_stage_against_brute_force(spark, tmp_path):
    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        return
    found = {}
    docs = spark.read.parquet(f"{data}/documents.parquet")
    docs = docs.union(docs.filter("doc_id % 40 = 1").selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))
    for name, stage in corpus_pipeline.STAGES:
        found[name] = (docs.collect(), stage(spark, docs, data))
        found[name][1].write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        found[name] = (found[name][0], docs.collect())
    plain = lambda rows: sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows), key=str)

    before, after = found["toxicity"]
    frame = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    model = toxicity.train(frame, spark.read.parquet(f"{data}/labels.parquet"))
    scores = toxicity.with_score(frame, model).collect()
    assert plain(after) == plain([r for r in scores if r["score"] < 0.3]) and 0 < len(after) < len(before)

    before, after = found["line_dedup"]
    cleaned = test_lines.brute(plain(before) and [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in before])
    assert plain(after) == sorted([(r["doc_id"], t, r["lang"], r["source"]) for r, t in zip(before, cleaned, strict=True)], key=str)
    assert all(r["n_chars"] == len(r["text"] or "") for r in after if r["text"] is not None)

    before, after = found["near_copies"]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in before]
    gone = {i for i, _, c in test_jaccard.brute(rows, corpus_pipeline.NEAR) if i != c}
    assert plain(after) == plain([r for r in before if r["doc_id"] not in gone]) and gone

    before, after = found["source_mix"]
    frame = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    decided = {(r["doc_id"], r["source"], r["size"]): r["taken"] for r in mixing.mix_sources(frame, mixing.quality(spark.read.parquet(f"{data}/labels.parquet")), whole=True).collect()}
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    expected = [r for r in before if size(r) for _ in range(decided[r["doc_id"], r["source"], size(r)] // size(r))]
    assert plain(after) == plain(expected) and any(r["doc_id"] is None for r in after)

    before, after = found["packing"]
    pieces = packing.cut_pieces(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    bins = test_packing.valid(pieces, after, 2048)
    assert bins <= -(-sum(r["length"] for r in pieces) // 2048) + 2


def test_run(spark, tmp_path):
    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        return
    packed = corpus_pipeline.run(spark, data)
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert fill.agg(F.max("n")).first()[0] <= 2048 and packed.count() > 0


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
