"""A corpus made ready for training: toxic documents out, one of each group of near copies, no benchmark passages, no
personal data, packed into sequences.

Each stage takes the documents that the stage before it kept, as Parquet read anew, and returns documents with the same
columns; the last one returns the packed pieces. Documents without a key pass every stage. Null texts are empty
documents: they are not toxic, not copies of anything, hold no passage and no personal data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm import contamination, jaccard, packing, pii, toxicity
from sievemark.llm.inputs import importable, table
from sievemark.sources.tables import discard, scratch_path, stored_result, temporary_copies

TOXIC_SCORE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below `TOXIC_SCORE`."""
    field = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, field).filter(F.col("_score") < TOXIC_SCORE).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies; of rows with one key and text, one.

    Texts that share a key are documents of their own, so groups are found by a hash of key and text.
    """
    importable(spark)
    row_keys = stored_result(spark, lambda: _first_of_groups(docs))
    keyed = _with_row_key(docs)
    first = keyed.join(row_keys, "_row_key", "left_semi").dropDuplicates(["_row_key"])
    return first.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def _with_row_key(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id IS NOT NULL").withColumn("_row_key", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))


def _first_of_groups(docs: DataFrame) -> DataFrame:
    """Keys of the rows that stay."""
    keyed = _with_row_key(docs)
    found = jaccard.near_duplicates(keyed.select(F.col("_row_key").alias("doc_id"), "text"))
    classes = found.groupBy(F.col("doc_id").alias("_row_key")).agg(F.min("class_id").alias("class_id"))
    keys = keyed.groupBy("_row_key").agg(F.min(F.col("doc_id").cast("long")).alias("doc_id"))
    kept = keys.join(classes, "_row_key").groupBy("class_id").agg(F.min(F.struct("doc_id", "_row_key")).alias("first"))
    return kept.select(F.col("first._row_key").alias("_row_key"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    hits = contamination.with_passages(docs, table(spark, sf_dir, "benchmark"))
    return hits.filter(F.size("_hit_words") == 0).select(docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences."""
    importable(spark)
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("packing", pack_sequences),
]

# Fitted models and tokenizers are no SQL; tests hold the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. What a stage kept is deleted when the next one is through; the result is left."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = scratch_path(spark)
        with temporary_copies(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
