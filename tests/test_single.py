"""One file from many tasks, against plain writers over all rows."""

import csv
import io
import json
from pathlib import Path

import pytest

from lumbung.sources import files, single

TEXTS = ["plain", 'quote " and, comma', "line\nbreak", "cr\r", "", None, "ünï 😀", "tab\t\x0b\x1f back\\slash", " , ", '"', "é x", "NaN", "-"]
SCHEMA = "No long, Title string, Year int, `od,d` string"


def rows(n):
    return [(i, TEXTS[i % len(TEXTS)], None if i % 7 == 0 else 2000 + i, TEXTS[-i % len(TEXTS)]) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 200])
def test_csv_is_what_one_writer_writes(spark, tmp_path, n):
    path = str(tmp_path / "out" / "d.csv")
    single.write_csv(spark.createDataFrame(rows(n), SCHEMA).repartition(7), path, ["No"])
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["No", "Title", "Year", "od,d"])
    writer.writerows([["" if v is None else v for v in r] for r in rows(n)])
    assert Path(path).read_bytes() == out.getvalue().encode("utf-8-sig")
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")] == ["d.csv"]


@pytest.mark.parametrize("n", [0, 1, 200])
def test_json_is_what_one_writer_writes(spark, tmp_path, n):
    path = str(tmp_path / "b.json")
    about = {"scraped_at": "2026-11-26T12:00:00+00:00", "years": [2025, 2026]}
    single.write_json(spark.createDataFrame(rows(n), SCHEMA).repartition(7), path, ["No"], about)
    plain = [dict(zip(["No", "Title", "Year", "od,d"], r, strict=True)) for r in rows(n)]
    assert Path(path).read_text(encoding="utf-8") == json.dumps(about | {"total": n, "rows": plain}, ensure_ascii=False, indent=2)


def test_a_failed_write_leaves_the_file(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("old")
    bad = spark.range(3).selectExpr("id", "raise_error('no') as x")
    with pytest.raises(Exception, match="no"):
        single.write_csv(bad, str(path), ["id"])
    assert path.read_text() == "old" and [p.name for p in tmp_path.iterdir()] == ["d.csv"]
    single.write_csv(spark.range(2), str(path), ["id"], bom=False)
    assert path.read_bytes() == b"id\n0\n1\n"


def test_the_dataset_is_read_back(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    single.write_csv(spark.createDataFrame([(1, 'a "b"\n', 2026)], "No long, Title string, Year int"), path, ["No"])
    row = files.read_dataset(spark, path).first()
    assert (row["No"], row["Title"], row["Year"]) == (1, 'a "b"\n', 2026)
