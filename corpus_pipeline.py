"""Training-corpus pipeline: language ID, exact dedup, SimHash near-dedup,
benchmark decontamination, best-fit packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and is written as Parquet in the shared folder and read back.  All but
the last return the columns of ``documents``; rows that share a doc_id are one
document to the filters and stay or go together.  Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ripplerec.llm import decontaminate, exact_dedup, langid, packing, simhash_dedup
from ripplerec.llm.common import store, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.accepted(docs.select(*COLUMNS))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.keep_largest(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the document with the smallest doc_id."""
    return simhash_dedup.keep_one(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL can't express the language models, the tiling or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the table ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = store(docs, f"stage{number}")
    return docs
