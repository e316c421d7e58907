"""The shared folder and other file systems: settled tables, small files that appear whole or not at all, and listings."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only where all runs in one process, as in tests, a temporary folder may stand in for it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lumbung-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own, not made yet, in the shared one."""
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, read back from the shared folder: computed once, and not lost with an executor."""
    shared(df.sparkSession)
    return df.checkpoint(eager=True)


def _at(spark: SparkSession, path: str):  # noqa: ANN202
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def listed(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Name, length and time of change of what is directly in a folder; nothing if there is none."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return {}
    return {f.getPath().getName(): (f.getLen(), f.getModificationTime()) for f in system.listStatus(where)}


def removed(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, *, replace: bool = True) -> bool:
    """Writes a small file beside its place and moves it there, so it is never seen in part. False if it is there already and must not be replaced."""
    system, where = _at(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    stream = system.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if system.exists(where) and not replace:
        system.delete(beside, False)
        return False
    return moved(spark, beside.toString(), path)


def moved(spark: SparkSession, source: str, path: str) -> bool:
    """Moves a file to its place, where it takes another's."""
    system, where = _at(spark, path)
    if system.exists(where):
        system.delete(where, False)
    return bool(system.rename(_at(spark, source)[1], where))
