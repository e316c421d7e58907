"""The pipeline over documents: toxicity, line dedup, near copies, mixing and packing, each by an operator of lumbung.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm import jaccard, lines, mixing, packing, toxicity
from lumbung.llm.common import prepare, read

#: Near copies: word 5-grams with a similarity of 0.8 or more.
NEAR = jaccard.Join(words=5, num=80, den=100)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic. It learns from the labels that op7 learns from, on the documents as they come in.

    Null, empty and very long texts are scored like others, whole; repeated rows and null ids are judged each on its own. An empty table stays empty.
    """
    return toxicity.drop_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; n_chars follows the text.

    No row goes: null texts stay null, a text that loses all its lines is empty. Null sources are a source of their own, repeated rows are pages of their own.
    """
    cleaned = lines.drop_lines(docs)
    return cleaned.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id.

    Rows of null id, and texts without words, stay. Rows that share the id that stays stay together; long texts are compared whole; an empty table stays empty.
    """
    return jaccard.drop_near_copies(docs, NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole, up to three times, rows of those that it does not take go, and those without words.

    Null ids, null sources and shared ids are mixed like others, each row by its own id, source and size.
    """
    return mixing.repeat_documents(docs, mixing.quality(read(spark, sf_dir, "labels")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens. Null and empty texts are a piece of one token; repeated rows and null ids are packed each."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_site_lines),
    ("near_copies", drop_near_copies),
    ("source_mix", mix),
    ("packing", pack),
]

#: The first, third and last stages cannot be said in SQL; they are tested against brute force and held-out accuracy.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. What a stage gives is written to the checkpoint folder and read again."""
    prepare(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
