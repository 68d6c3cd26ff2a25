"""The corpus pipeline: stages over ``documents``, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm import decontaminate, jaccard, packing, pii, toxicity
from skytally.llm.common import prepare, read_table, stored


def row_key() -> F.Column:
    """Tells rows apart by id and text, also where ids are null or repeated."""
    return F.xxhash64("doc_id", "text")


def spare_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have yet."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.5.

    Null and empty texts, and texts without words, have the score of the model's bias; equal rows
    have equal scores, so all of them stay or go. An empty table, or one without labels, loses
    nothing that the bias does not reject. Further columns stay as they are.
    """
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by five-word shingles and a Jaccard similarity of 0.8, that with the smallest id.

    Only rows linked to another row go. Null and empty texts link with nothing and stay, as do rows
    with a null id. Equal rows with words are copies of each other: one stays. Where an id is
    repeated, its texts are compared one by one; of several texts of a group's smallest id the one
    of the smallest hash stays. An empty table stays empty, further columns as they are.
    """
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    repeated = stored(rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "near-copies-ids")
    if not repeated.limit(1).count():
        classes = stored(jaccard.similarity_classes(docs, n=5, percent=80).select("doc_id", "component_id"), "near-copies")
        gone = stored(classes.where("component_id <> doc_id").select("doc_id").distinct(), "near-copies-gone")
        return docs.join(gone, "doc_id", "left_anti")
    texts = jaccard.text_classes(rows, n=5, percent=80).where("doc_id is not null and n_shingles > 0")
    texts = stored(texts.groupBy("row_key", "doc_id", "component").agg(F.count("*").alias("copies")), "near-copies")
    stays = texts.groupBy("component").agg(F.min_by("row_key", F.struct("doc_id", "row_key")).alias("stays"))
    names = {c: spare_name(docs, c) for c in ("copy_key", "copy_id", "copies", "stays", "copy_rank")}
    verdict = stored(texts.join(stays, "component").select(
        F.col("row_key").alias(names["copy_key"]), F.col("doc_id").alias(names["copy_id"]), F.col("copies").alias(names["copies"]),
        (F.col("row_key") == F.col("stays")).alias(names["stays"])), "near-copies-verdict")
    ident = F.col("doc_id").cast("long")
    judged = docs.join(verdict, (F.xxhash64(ident, "text") == F.col(names["copy_key"])) & (ident == F.col(names["copy_id"])), "left")
    kept = judged.where(F.coalesce(F.col(names["stays"]), F.lit(True)))
    once = F.coalesce(F.col(names["copies"]), F.lit(1)) == 1
    equal = Window.partitionBy(names["copy_key"], names["copy_id"]).orderBy(names["copy_key"])
    first = kept.where(~once).withColumn(names["copy_rank"], F.row_number().over(equal)).where(F.col(names["copy_rank"]) == 1)
    return kept.where(once).select(docs.columns).union(first.select(docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage of ten words (or whole shorter item).

    Null and empty texts hold no passage and stay, also with a null id; equal rows stay or go
    together. Without benchmark items nothing goes. Further columns stay as they are.
    """
    keyed = docs.select(row_key().alias("doc_id"), "text")
    matches = decontaminate.find_matches(
        decontaminate.build_index(keyed), read_table(spark, sf_dir, "benchmark"), slop=0)
    key = spare_name(docs, "contaminated_key")
    gone = stored(decontaminate.contamination(matches).where("contaminated")
                  .select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return docs.join(gone, row_key() == F.col(key), "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets and n_chars counted again.

    Null texts stay null and empty ones empty; equal rows are masked alike. An empty table stays
    empty. Further columns stay as they are.
    """
    prepare(spark)
    return pii.mask_pii(docs, pii.fit_crf(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens, see ``packing.pack``."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal data", mask_personal_data),
    ("packing", pack_sequences),
]

# A trained classifier, message passing and a tokenizer are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
