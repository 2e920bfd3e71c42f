"""The queries of this subpackage: names, functions and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.llm import decontam, fingerprints, langid, licenses, line_dedup, merkle, mixing, near_dup, pii, repeats, secrets, spelling, toxicity


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.jaccard_classes(_table(spark, folder, "documents")).drop("mark")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.line_dedup(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "kept_sha256")


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.decontamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op4_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(_table(spark, folder, "documents"))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(_table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents")).drop("copies")


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_digests(_table(spark, folder, "documents"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identified(_table(spark, folder, "documents"))


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tampered_digests(_table(spark, folder, "documents"))


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_digests(_table(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.slipped_variants(_table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_line_dedup, op3_decontaminate, op4_repeated_bytes, op5_personal_data, op6_toxicity, op7_mix_sources,
    op8_secret_scan, op9_language_id, op10_fingerprints, op11_merkle_manifest, op12_license_scan, op13_spelling_variants,
)}
SQL = {"op2_line_dedup": line_dedup.SQL, "op7_mix_sources": mixing.SQL, "op11_merkle_manifest": merkle.SQL, "op13_spelling_variants": spelling.SQL}
