"""Files: the published CSV and the JSON backup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import exists

_INTS = ("No", "Year", "Month", "Week", "Minggu_ke")
_TEXTS = ("Source", "Title", "Content", "Minggu_Mulai", "Week_Label", "Penyakit", "Lokasi", "url")
DATASET = "No bigint, Source string, Title string, Content string, Year int, Month int, Week int, Minggu_ke int, Minggu_Mulai string, Week_Label string, Penyakit string, Lokasi string, url string"
# Texts that stand for a missing value in CSV files.
_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _known(x: Column) -> Column:
    return F.when(~x.isin(*_NULLS), x)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The published CSV in its schema, one file or a folder of them; an empty table if there is none. A byte-order mark is not part of the first name. Numbers may be written as 2026.0, missing ones as NA."""
    if not exists(spark, path):
        return spark.createDataFrame([], DATASET)
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    raw = raw.toDF(*[c.removeprefix("\ufeff") for c in raw.columns])
    names = [f.split()[0] for f in DATASET.split(", ")]
    number = lambda c: F.expr(f"try_cast(try_cast(`{c}` as double) as {'bigint' if c == 'No' else 'int'})")
    columns = [number(c).alias(c) if c in _INTS else _known(F.col(c)).alias(c) for c in names if c in raw.columns]
    found = raw.select(columns)
    for c in names:
        if c not in found.columns:
            found = found.withColumn(c, F.lit(None).cast("int" if c in _INTS else "string"))
    return found.select(names)


def write_dataset(df: DataFrame, path: str, *, files: int | None = None) -> None:
    """CSV with a header in each file, quotes doubled. files: how many, for readers that take one; each is then written by one task."""
    (df.coalesce(files) if files else df).write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').csv(path)


def write_backup(df: DataFrame, path: str, years: list[int], scraped_at: str) -> None:
    """A JSON line for each row, and beside it one with scraped_at, years and total: a document of all rows in one would have to fit into a task."""
    df.write.mode("overwrite").json(f"{path}/rows")
    total = df.agg(F.count(F.lit(1)).alias("total"))
    total.select(F.lit(scraped_at).alias("scraped_at"), F.array(*map(F.lit, years)).alias("years"), "total").coalesce(1).write.mode("overwrite").json(f"{path}/about")
