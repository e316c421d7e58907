"""Hosts with few pages lose their boilerplate too, in the query and in the pipeline's stage."""

import corpus_pipeline
from lumbung.llm import queries

from .fixtures import documents, words
from .test_lines import brute


def test_small_hosts(spark, tmp_path):
    rows, sizes = [], {"three": 3, "five": 5, "twelve": 12, "fifty": 50, "two": 2}
    for host, n in sizes.items():
        for i in range(n):
            footer = ["footer"] if host != "fifty" or i < 6 else []
            rows.append((len(rows), "\n".join([words(6, len(rows)), *footer, "twice" if i < 2 else "once " + words(4, 500 + len(rows))]), "en", host))
    expected = brute(rows, least=3)
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["text"] for r in queries.op2_line_dedup(spark, str(tmp_path)).collect()}
    staged = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_site_lines(spark, documents(spark, rows), str(tmp_path)).collect()}
    assert [found[r[0]] for r in rows] == expected and staged == found
    assert {r[3] for r in rows if "footer" in found[r[0]]} == {"two"} and sum("twice" in t for t in found.values()) == 10
