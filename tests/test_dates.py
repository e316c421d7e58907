import datetime as dt

import pytest
from pyspark.sql import functions as F

from lumbung.functions import dates

AS_OF = "2026-11-26T12:00:00"


def parsed(spark, raw, as_of=AS_OF, **options):
    r = spark.createDataFrame([(raw,)], "x string").select(dates.parse_date(F.col("x"), as_of, **options).alias("d")).first()["d"]
    return r and (r["local"], r["instant"])


@pytest.mark.parametrize(
    ("raw", "as_of", "local"),
    [
        ("2025-03-12", AS_OF, "2025-12-03 00:00"), ("20250312", AS_OF, "2025-12-03 00:00"), ("2025/03/12", AS_OF, "2025-12-03 00:00"), ("2025-03-12T10:00:00+07:00", AS_OF, "2025-12-03 10:00"),
        ("2026-03-12", AS_OF, "2026-03-12 00:00"), ("2025-03-13", AS_OF, "2025-03-13 00:00"), ("12/03/2026", AS_OF, "2026-03-12 00:00"), ("12.03.2026", AS_OF, "2026-03-12 00:00"), ("12-03-26", AS_OF, "2026-03-12 00:00"),
        ("07/06/2026", "2026-06-10T00:00:00", "2026-06-07 00:00"), ("06/07/2026", "2026-06-10T00:00:00", "2026-06-07 00:00"), ("12 Maret 2026", AS_OF, "2026-03-12 00:00"), ("Kamis, 12 Mar 2026 10:00", AS_OF, "2026-03-12 10:00"),
        ("Thursday, 12 March 2026 10:00 WIB", AS_OF, "2026-03-12 10:00"), ("10:30", AS_OF, "2026-11-26 10:30"), ("foo", AS_OF, None), ("Update 12 March 2026", AS_OF, None), ("", AS_OF, None), (None, AS_OF, None), ("31/12/2027", AS_OF, None),
    ],
)
def test_formats(spark, raw, as_of, local):
    found = parsed(spark, raw, as_of)
    assert (found and found[0].strftime("%Y-%m-%d %H:%M")) == local


def test_offsets_keep_the_wall_clock(spark):
    local, instant = parsed(spark, "2026-01-01T00:30:00+07:00", policy="iso_strict")
    assert local == dt.datetime(2026, 1, 1, 0, 30) and instant.year == 2025 or instant == dt.datetime(2025, 12, 31, 17, 30)
    assert parsed(spark, "2025-03-12", policy="iso_strict")[0] == dt.datetime(2025, 3, 12)


@pytest.mark.parametrize(("day", "fields"), [("2024-12-30", (1, 5, "2024-12-30", "2025-W01")), ("2026-01-01", (1, 1, "2025-12-29", "2026-W01")), ("2027-01-01", (53, 1, "2026-12-28", "2026-W53")), ("2021-01-03", (53, 1, "2020-12-28", "2020-W53")), ("2025-03-31", (14, 5, "2025-03-31", "2025-W14")), (None, (None,) * 4)])
def test_weeks(spark, day, fields):
    made = dates.week_fields(F.col("d").cast("timestamp_ntz"))
    row = spark.createDataFrame([(day,)], "d string").select(*[made[k].alias(k) for k in ("Week", "Minggu_ke", "Minggu_Mulai", "Week_Label")]).first()
    assert tuple(row) == fields


def test_url_dates(spark):
    urls = ["https://x/2025/02/28/z", "https://x/2025/02/30/z", "https://x/2025/13/01/2025/02/01/", "https://x/2099/01/01/z", "https://x"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(dates.date_from_url(F.col("u"), dates.instant(AS_OF))["local"].cast("string")).collect()
    assert [r[0] for r in rows] == ["2025-02-28 00:00:00", None, None, None, None]


def test_week_window_and_months(spark):
    rows = [("2026-11-22T23:59:59",), ("2026-11-23T00:00:00",), ("2026-11-29T23:59:59",), ("2026-11-30T00:00:00",)]
    found = spark.createDataFrame(rows, "t string").select(dates.in_week(F.col("t").cast("timestamp"), dates.instant(AS_OF))).collect()
    assert [r[0] for r in found] == [False, True, True, False]
    assert [str(r[0]) for r in dates.last_months(spark, "2026-01-15T00:00:00").orderBy("month_start").collect()] == ["2025-11-01", "2025-12-01", "2026-01-01"]
    assert dates.months_of(spark, [2025, 2026], "2026-02-01T00:00:00").count() == 14
    assert spark.range(1).select(dates.commit_label(dates.instant("2027-01-01T00:00:00"))).first()[0] == "W00-2027"


def test_names_are_translated_once(spark):
    row = spark.createDataFrame([("Minggu, 5 mei 2025 x Marett desember",)], "x string").select(dates.translate_names(F.col("x"))).first()
    assert row[0] == "Sunday, 5 May 2025 x Marett December"


RAW = [
    "12 Maret 2026", "Kamis, 12 Mar 2026 10:00", "Thu, 12 Mar 2026 10:00:00 +0700", "Thu, 12 Mar 2026 23:30:00 -0500", "12 mei 2025, 9:05 WIB", "31 Februari 2026", "1 Des 2027", "5 sept 2025 7:00 GMT", "12 Marett 2026",
    "Jum'at 3 Okt 2025 14:00:59 WITA", "3 Agu 2025 25:00", "2025-03-12", "12/03/2026", "July 4, 2025", "4 July 2025 UTC", "foo", "", None, "  7 Juni 2025\n", "20250312", "00 Mei 2025", "32 Mei 2025",
]


def test_expressions_read_as_dateutil_does(spark):
    rows = spark.createDataFrame([(i, r, [r]) for i, r in enumerate(RAW)], "i int, x string, xs array<string>")
    found = dates.with_date(rows, F.col("x"), "d", AS_OF).withColumn("e", dates.parse_date(F.col("x"), AS_OF)).withColumn("f", dates.first_date(F.col("xs"), AS_OF))
    for r in found.collect():
        assert r["d"] == r["e"] == r["f"], r["x"]
    local = {r["x"]: r["d"] and str(r["d"]["local"]) for r in found.collect()}
    assert local["Thu, 12 Mar 2026 10:00:00 +0700"] == "2026-03-12 10:00:00" and local["31 Februari 2026"] is None and local["1 Des 2027"] is None
    read = rows.select(dates._written(F.col("x"), dates._NAMED).alias("n"), "x").filter("n is not null").count()
    assert read >= 8  # by expressions alone


def test_first_date_goes_on_to_the_next(spark):
    rows = spark.createDataFrame([(["foo", "1 Jan 2030", " 2 Maret 2026 ", "3 Maret 2026"],), ([],), (None,), ([None, ""],), (["x"] * 40 + ["2026-01-31"],)], "xs array<string>")
    found = [r[0] and str(r[0]["local"].date()) for r in rows.select(dates.first_date(F.col("xs"), AS_OF)).collect()]
    assert found == ["2026-03-02", None, None, None, "2026-01-31"]
