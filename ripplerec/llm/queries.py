"""Registered queries: every operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate,
    exact_dedup,
    html_extract,
    langid,
    merkle,
    nearest,
    packing,
    secrets,
    simhash_dedup,
    spelling,
    substring_dedup,
    token_counts,
    toxicity,
)
from .common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(table(spark, sf_dir, "embeddings"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_check(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secrets, op2_main_text, op3_language_id, op4_simhash, op5_exact_dedup, op6_toxicity, op7_token_counts,
    op8_substring_dedup, op9_decontamination, op10_packing, op11_spelling, op12_nearest, op13_manifest)}

ORACLE_SQL = {"op5_exact_dedup": exact_dedup.ORACLE_SQL, "op12_nearest": nearest.ORACLE_SQL,
              "op13_manifest": merkle.ORACLE_SQL}
