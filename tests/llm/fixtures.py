"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

#: Extra columns whose names an operator might use itself.
CLASHING = ["key", "size", "bucket", "rank", "score", "cluster", "sid", "name", "token", "cell", "island", "bin", "fill", "line", "host", "text_id", "weight", "target", "taken", "label_id", "node", "u", "v", "a", "b", "n"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))


def texts() -> list[tuple]:
    long = words(30_000, 1)
    base = words(120, 2)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base, "en", "s1"), (2, base, "en", "s1"), (2, base, "en", "s1"), (3, " ".join(near), None, "s2"), (4, None, "en", "s1"), (5, "", "en", None), (6, " \t\n ", "en", "s2"),
        (7, long, "de", "s1"), (8, "one", "en", "s2"), (9, "two words", "en", "s2"), (None, "a text without an id", "en", "s3"), (10, words(200, 3) + "\nsame line\n" + words(9, 4), "fr", "s1"),
        (11, "ünï \u0000 \U0001f600 text end", "en", ""),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * len(CLASHING)) for r in rows], SCHEMA)
