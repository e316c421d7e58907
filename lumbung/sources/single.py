"""One file written by many tasks: ordered parts, stitched in a second step behind a head.

Tasks write their rows, in order, as parts in a folder of this write's own. When all are there the file is put together beside its place, by copying streams of a few kilobytes at
a time, and moved there; a write that fails leaves the file that there was as it is, and its parts are removed. What is written is byte for byte
what one plain writer over all rows would write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import store
from ..ship import shipped

BOM = "﻿"


def _field(column: Column) -> Column:
    """A CSV field: quoted if it has a comma, a quote or an end of line in it, quotes doubled; empty for null."""
    text = column.cast("string")
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(text.rlike('[",\r\n]'), quoted).otherwise(text), F.lit(""))


def _copied(spark: SparkSession, path: str, out, length: int) -> None:  # noqa: ANN001
    system, where = store._at(spark, path)
    stream = system.open(where)
    try:
        spark._jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out, 0, length)
    finally:
        stream.close()


def _stitched(lines: DataFrame, path: str, head: str, tail: str, *, less: int = 0) -> None:
    """Lines (column value, in the order of partitions), each ended, behind head and before tail. less: bytes that the last line's end is shorter by."""
    spark = lines.sparkSession
    name = path.rstrip("/").rpartition("/")[2]
    parts, beside = f"{path}.parts-{uuid.uuid4().hex}", f"{path.rpartition('/')[0]}/.{name}.{uuid.uuid4().hex}"
    try:
        lines.write.option("compression", "none").text(parts)
        sizes = [(n, size) for n, (size, _) in sorted(store.listed(spark, parts).items()) if n.startswith("part-") and size]
        system, where = store._at(spark, beside)
        out = system.create(where, True)
        try:
            out.write(bytearray(head.encode()))
            for i, (n, size) in enumerate(sizes):
                _copied(spark, f"{parts}/{n}", out, size - (less if i == len(sizes) - 1 else 0))
            out.write(bytearray(tail.encode()))
        finally:
            out.close()
        if not store.moved(spark, beside, path):
            raise OSError(f"{path} could not be put in its place")
    finally:
        store.removed(spark, parts)
        store.removed(spark, beside)


def write_csv(df: DataFrame, path: str, order: Sequence[str | Column], *, bom: bool = True) -> None:
    """df as one CSV file with a header, rows in an order without ties, behind a byte-order mark unless told otherwise; lines end with a newline."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # fields are joined with null-safe texts, so a line is never null
    lines = ordered.select(F.concat_ws(",", *[_field(F.col(f"`{c}`")) for c in df.columns]).alias("value"))
    header = ",".join(f'"{c.replace(chr(34), chr(34) * 2)}"' if any(x in c for x in ',"\r\n') else c for c in df.columns)
    _stitched(lines, path, (BOM if bom else "") + header + "\n", "")


def write_json(df: DataFrame, path: str, order: Sequence[str | Column], about: dict) -> None:
    """One JSON document: what about says, then total, the number of rows, and the rows in an order without ties; indented by two, characters as they are."""
    shipped(df.sparkSession)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    ordered = store.settled(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    names, total = df.columns, ordered.count()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for packed in b["row"]:
                values = json.loads(packed)
                row = json.dumps({c: values.get(c) for c in names}, ensure_ascii=False, indent=2)
                rows.append("    " + row.replace("\n", "\n    ") + ",")
            yield pd.DataFrame({"value": rows})

    lines = ordered.select(F.to_json(F.struct(*[f"`{c}`" for c in names])).alias("row")).mapInPandas(run, "value string")
    head = json.dumps(about | {"total": total}, ensure_ascii=False, indent=2)[: -len("\n}")] + ',\n  "rows": ['
    _stitched(lines, path, head + ("\n" if total else ""), ("\n  ]" if total else "]") + "\n}", less=len(",\n") if total else 0)


def read_json(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """The rows of such a document, and what it says besides. Its file is read by one task, as any JSON document that spans lines is."""
    whole = spark.read.option("multiLine", True).json(path)
    about = whole.select([c for c in whole.columns if c != "rows"]).first().asDict()
    return whole.select(F.explode("rows").alias("r")).select("r.*"), about
