"""The operators on the given tables, as the driver runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearthline.llm import (
    decontamination,
    digests,
    licenses,
    line_dedup,
    near_minhash,
    near_simhash,
    packing,
    quality,
    secrets_ledger,
    structure_repair,
    token_counts,
    toxicity,
    whitening,
)
from hearthline.llm.common import table


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents"), wide=True)


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.of_documents(table(spark, folder, "documents"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_digests(spark: SparkSession, folder: str) -> DataFrame:
    return digests.fingerprints(table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_ledger.in_two_scans(table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_simhash.near_duplicates(table(spark, folder, "documents"))


def op11_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_minhash.near_duplicates(table(spark, folder, "documents"))


def op12_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return structure_repair.structure_repair(table(spark, folder, "conversations"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_licenses": op2_licenses,
    "op3_decontamination": op3_decontamination,
    "op4_digests": op4_digests,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_secrets": op7_secrets,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_minhash": op11_minhash,
    "op12_structure_repair": op12_structure_repair,
    "op13_whitening": op13_whitening,
}
ORACLES = {"op2_licenses": licenses.oracle(), "op7_secrets": secrets_ledger.oracle()}
