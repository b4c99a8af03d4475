"""Corpus pipeline: quality rules, language, near duplicates, personal data, packing.

Each stage gets all documents that the stage before it kept, and what it decides takes
effect: rejected documents go, one document of each group of near duplicates stays,
personal data is masked in the text, and the last stage returns the packed pieces.  All
stages but the last return the columns of ``documents``, extra ones included.  An empty
table passes through every stage.

ORACLE_SQL is None: trained models and packing have no SQL form; the tests hold each
stage against a brute-force version of its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import dedup, langid, packing, pii, quality
from tessera.llm.common import table, written

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the trees reject."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a calibrated score of at least one half."""
    return langid.keep(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five-word shingles, 0.8)."""
    return dedup.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in the text."""
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
