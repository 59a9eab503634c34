"""Registered queries of the text operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievemark.llm import contamination, id_files, jaccard, language, packing, periods, pii, quality, secret_scan, suffixes, toxicity, vectors, whitening
from sievemark.llm.inputs import table
from sievemark.llm.oracle import ORACLE_SQL  # noqa: F401
from sievemark.sources.tables import scratch_path, stored_result


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_result(spark, lambda: suffixes.repeated_text(table(spark, sf_dir, "documents")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pivot_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_result(spark, lambda: vectors.near_vectors(table(spark, sf_dir, "embeddings")))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_result(spark, lambda: jaccard.near_duplicates(table(spark, sf_dir, "documents")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_bit_plane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest() -> DataFrame:
        path = scratch_path(spark)
        id_files.write_ids(table(spark, sf_dir, "documents"), path)
        return id_files.id_digest(spark, path)

    return stored_result(spark, digest)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_result(spark, lambda: packing.packed_documents(table(spark, sf_dir, "documents")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_result(spark, lambda: whitening.whitened_vectors(table(spark, sf_dir, "embeddings")))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.planted_runs(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_language": op3_language,
    "op4_pivot_near_dedup": op4_pivot_near_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op7_toxicity": op7_toxicity,
    "op9_quality": op9_quality,
    "op6_decontamination": op6_decontamination,
    "op8_bit_plane_ids": op8_bit_plane_ids,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_secret_scan": op12_secret_scan,
    "op13_periodic_runs": op13_periodic_runs,
}
