"""The queries opN_<name>: each applies its operator to its whole table and returns the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact, jaccard, licenses, lines, markup, media, mixing, packing, pii, resample, topk, toxicity, turns
from .common import read


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all vectors for each vector whose id is divisible by 50."""
    rows = topk.quantize(read(spark, sf_dir, "embeddings"))
    return topk.search(rows, rows.filter("vec_id % 50 = 0"), k=5)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the boilerplate lines of their source, which stands for the host."""
    return lines.drop_lines(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of all pages."""
    return markup.extract(read(spark, sf_dir, "pages"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: plain spans and those that deobfuscation adds."""
    return pii.scan(read(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License texts in all documents, with coverage and spans."""
    return licenses.scan(read(spark, sf_dir, "documents"))


def op6_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents stored as Ogg files and read back."""
    return media.digests(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of the labels that are not held out."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by 3-word shingles and a similarity of 0.9."""
    return jaccard.join_components(read(spark, sf_dir, "documents"), jaccard.Join(words=3, num=90, den=100))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3, repeating; labelled quality scales the sampling keys."""
    return mixing.mix_sources(read(spark, sf_dir, "documents"), mixing.quality(read(spark, sf_dir, "labels")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their score towards the benchmark's distribution of features, and the quarter that is drawn."""
    return resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule, with their faults and their cheapest repair."""
    return turns.damaged_report(read(spark, sf_dir, "conversations"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the row of their text that stays."""
    return exact.groups(read(spark, sf_dir, "documents"))


def pii_base_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op4's base spans hold, by document and kind: those of its spans that plain patterns find."""
    return pii.base_values(read(spark, sf_dir, "documents"))


def media_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op6 that SQL can tell without a file: sizes and the payload's digest."""
    return media.digests(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


def packing_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op9's sequences hold: whether they are gapless and within bounds, and whether their pieces are whole documents. One row."""
    return packing.audit(packing.pack_documents(read(spark, sf_dir, "documents")))


QUERIES = {
    "op1_exact_topk": op1_exact_topk,
    "op2_line_dedup": op2_line_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_pii": op4_pii,
    "op5_license_scan": op5_license_scan,
    "op6_ogg_media": op6_ogg_media,
    "op7_toxicity": op7_toxicity,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_source_mix": op10_source_mix,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_exact_dedup": op13_exact_dedup,
    "pii_base_values": pii_base_values,
    "media_payloads": media_payloads,
    "packing_pieces": packing_pieces,
}

ORACLE_SQL = {
    "op1_exact_topk": topk.ORACLE_SQL,
    "op2_line_dedup": lines.ORACLE_SQL,
    "op8_jaccard_join": jaccard.ORACLE_SQL,
    "op10_source_mix": mixing.ORACLE_SQL,
    "op11_importance_resampling": resample.ORACLE_SQL,
    "op12_conversation_repair": turns.ORACLE_SQL,
    "op13_exact_dedup": exact.ORACLE_SQL,
    "pii_base_values": pii.BASE_SQL,
    "media_payloads": media.PAYLOAD_SQL,
    "packing_pieces": packing.AUDIT_SQL,
}
