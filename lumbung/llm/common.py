"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import free_name  # noqa: F401  the operators take it from here
from ..ship import shipped

#: A word, in the syntax that Java, Python and RE2 share.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch: texts may be long, and a batch is held as a whole.
BATCH_ROWS = 2000

#: Bytes of an Arrow batch, about: it is held by the JVM, by the worker and as Python objects at once, in each of an executor's tasks.
BATCH_BYTES = 8 << 20


#: Rows of ids up to which a side of a join is broadcast, some tens of MB; texts then stay where they are.
BROADCAST_ROWS = 500_000


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives freed memory back to the system when its task ends: Python workers live on, idle or for other queries."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library keeps its memory
                pass

    return wrapped


def prepare(spark: SparkSession) -> SparkSession:
    """Sends this package to Python workers, bounds Arrow batches, and sets a checkpoint folder where none is set.

    spark.checkpoint.dir names a shared folder and is used as it is. Only where all runs in one process, as in tests, a temporary folder stands in for it.
    """
    context = spark.sparkContext
    shipped(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    held = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()) > BATCH_BYTES:
        spark.conf.set(held, BATCH_BYTES)
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lumbung-"))
    return spark


def map_texts(docs: DataFrame, run: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """run() over batches of doc_id and text of docs, to rows of a schema that begins with "doc_id long".

    Ids go through Python as text: in a batch with a null, numbers would become doubles, and those above 2**53 others.
    """
    slim = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    rows = slim.mapInPandas(frugal(run), schema.replace("doc_id long", "doc_id string", 1))
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder: computed once, and not lost with an executor."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def land(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as Parquet to the shared checkpoint folder and read again: like cut(), but columns can be read one by one and are compressed."""
    spark = prepare(df.sparkSession)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def within_bounds(rows: DataFrame) -> DataFrame:
    """Rows of a few numbers, to be broadcast if a count shows that they are under BROADCAST_ROWS; more are shuffled."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession, least: int = 1) -> int:
    """Partitions for a shuffle dealt by hand: what the session names, at least one for each core."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
