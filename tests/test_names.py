"""Columns of a caller that have the library's own names stay as they are."""

import pytest
from pyspark.sql import functions as F

from lumbung.functions import dates
from lumbung.operators import relational as rel

OWN = ["__place", "__mark", "__part", "__start", "__rows", "__stop", "__source", "__before", "__first", "__date_text", "__date_one", "__date_first"]


def test_names(spark):
    rows = spark.range(6).select("id", (F.col("id") % 2).alias("k"), F.lit("3 Mei 2025").alias("raw"), (F.col("id") == 4).alias("is_empty"), *[F.lit(n).alias(n) for n in OWN])
    made = {
        "first": rel.keep_first(rows, "k", ["id"]), "last": rel.keep_last(rows, "k", ["id"]), "numbers": rel.number_rows(rows, [F.col("id")]), "dates": dates.with_date(rows, F.col("raw"), "date", "2026-01-01"),
        "stop": rel.until_first_empty(rows, "k", "id"), "batches": rel.cap_batches(rows, "k", 2), "merged": rel.merge_by_url(rows, rows, "id", "id", side="__side"),
    }
    for name, found in made.items():
        collected = found.collect()
        assert collected and all(r[n] == n for r in collected for n in OWN), name
        assert set(rows.columns) <= set(found.columns), name
    assert [r["No"] for r in made["numbers"].orderBy("id").collect()] == [1, 2, 3, 4, 5, 6] and {r["id"] for r in made["stop"].collect()} == {0, 2, 1, 3, 5}
    with pytest.raises(ValueError, match="__source"):
        rel.merge_by_url(rows, rows, "id", "id")
