"""Columns of a caller that have an operator's own names stay as they are."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumbung.llm import exact, jaccard, lines, mixing

from .fixtures import documents, texts, words

PACKAGE = Path(jaccard.__file__).parents[1]
#: All names in quotes, of the whole library, that begin with an underscore.
OWN = sorted({n for p in PACKAGE.rglob("*.py") for n in re.findall(r"""["'](__?[a-z][a-z_]*[a-z])["']""", p.read_text()) if not n.endswith("__")} | {"__mix_doc_id", "__mix_times", "__mix_size", "__mix_source"})


def table(spark):
    rows = [(r[0], (r[1] or "") + "\nfooter", "en", "s") for r in texts()] + [(50 + i, words(30, 90 + i // 2) + "\nfooter", "en", "s") for i in range(12)]
    docs = documents(spark, rows)
    return docs.select("*", *[F.lit(f"own {n}").alias(n) for n in OWN])


@pytest.mark.parametrize("stage", ["lines", "mixing", "jaccard", "exact"])
def test_names(spark, stage):
    docs = table(spark)
    stages = {
        "lines": lambda d: lines.drop_lines(d).drop("n_lines", "n_dropped"), "mixing": mixing.repeat_documents, "exact": exact.drop_copies,
        "jaccard": lambda d: jaccard.drop_near_copies(d, corpus_pipeline.NEAR),
    }
    found, plain = stages[stage](docs), stages[stage](docs.drop(*OWN))
    assert found.columns == docs.columns and len(OWN) > 8
    rows = found.collect()
    assert all(r[n] == f"own {n}" for r in rows for n in OWN)
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    assert sorted(map(key, rows)) == sorted(map(key, plain.collect())) and rows


def test_names_in_parts_of_hosts(spark, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    monkeypatch.setattr(lines, "PART_PAGES", 3)
    found = lines.drop_lines(table(spark)).collect()
    assert all(r[n] == f"own {n}" for r in found for n in OWN) and not any("footer" in r["text"] for r in found) and len(found) == 25
