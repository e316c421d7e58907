import itertools
import random

from pyspark.sql import functions as F

from lumbung.functions import dates

AS_OF = "2026-11-26T12:00:00"
SHAPES = [
    "2026-03-12", "2026-03-12T10:00:00Z", "2026-03-12T23:30:00+07:00", "12/03/2026", "3-12-2026", "12 Mar 2026", "Kamis, 12 Maret 2026 10:00 WIB", "Thu, 12 Mar 2026 10:00:00 +0700", "12 Mei 2026 10:00", "2027-01-05", "5 Januari 2094",
    "March 5, 2026", "soon", "", " \t", None, "2026", "31 Juni 2026", "kemarin 10:00", "Rabu 4 Maret 2026, pukul 9", "20260312", "10:30", "12.03.2026", "2026/03/12 08:15",
]


def test_first_date_by_expressions_is_first_date(spark):
    r = random.Random(5)
    arrays = [[s] for s in SHAPES] + [list(p) for p in itertools.product(["soon", None, "2094-01-01", "x 5 March 2026"], ["2026-03-12", "", "12 Mei 2026", "31 Juni 2026"])]
    arrays += [[r.choice(SHAPES) for _ in range(r.randint(0, 6))] for _ in range(150)] + [None, []]
    table = spark.createDataFrame(list(enumerate(arrays)), "i long, raw array<string>")
    for policy in ("reference", "iso_strict"):
        plain = table.select("i", dates.first_date(F.col("raw"), AS_OF, policy=policy).alias("a"))
        both = dates.with_first_date(table, F.col("raw"), "b", AS_OF, policy=policy).join(plain, "i").collect()
        assert len(both) == len(arrays)
        for row in both:
            assert row["a"] == row["b"], (policy, row["raw"], row["a"], row["b"])


def test_usual_shapes_do_not_go_to_python(spark, monkeypatch):
    rows = [["2026-03-12"], ["12/03/2026", "soon"], ["Kamis, 12 Maret 2026 10:00 WIB"], ["Thu, 12 Mar 2026 10:00:00 +0700", "x"], ["2026-03-12T23:30:00+07:00"], ["2094-01-01", "12 Mei 2026 10:00"], [], None]
    table = spark.createDataFrame([(r,) for r in rows], "raw array<string>")
    asked = F.lit(None).cast(f"array<{dates.STRUCT}>")
    monkeypatch.setattr(dates, "_first_udf", lambda *_: lambda c: F.when(c.isNotNull(), F.raise_error(F.lit("asked")).cast(f"array<{dates.STRUCT}>")).otherwise(asked))
    found = dates.with_first_date(table, F.col("raw"), "d", AS_OF).collect()
    assert sum(r["d"] is not None for r in found) == 6
