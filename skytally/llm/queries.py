"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import (
    alignment, ann, bpe, decontaminate, jaccard, licenses, merkle, packing, pii, quality, suffix, toxicity, warc,
)
from skytally.llm.common import read_table
from skytally.llm.oracles import ORACLES  # noqa: F401 - registered with the queries

# Archive date of the converted pages.
ARCHIVE_TIME = datetime(2026, 1, 1, tzinfo=timezone.utc)


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return quality.score_quality(documents, quality.fit_quality(documents))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).drop("matches")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return pii.find_pii(documents, pii.fit_crf(documents)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(read_table(spark, sf_dir, "documents"), n=3, percent=90).drop("n_links")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit_toxicity(documents, labels, keep=~held_out)
    return toxicity.score_toxicity(documents, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.build_index(read_table(spark, sf_dir, "documents"))
    matches = decontaminate.find_matches(index, read_table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination(matches).drop("n_near")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(read_table(spark, sf_dir, "pages"), ARCHIVE_TIME)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(read_table(spark, sf_dir, "documents"), length=200).drop("spans", "kept")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read_table(spark, sf_dir, "documents"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.verify_documents(read_table(spark, sf_dir, "documents"), tampered)


QUERIES = {f.__name__: f for f in (
    op1_nearest_neighbours, op2_quality_classifier, op3_packing, op4_license_scan, op5_pii, op6_jaccard_join,
    op7_toxicity, op8_decontamination, op9_warc, op10_suffix_dedup, op11_alignment, op12_bpe, op13_merkle_manifest)}
