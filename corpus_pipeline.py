"""A training corpus from the documents: filter, grade, drop copies, redact, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import grader, near_duplicates, outliers, personal_data
from tidemark.llm.common import landed, table
from tidemark.llm.queries import packed_pieces


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the fixed rules nor stand apart from their language and source."""
    return outliers.accepted(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents likely to be of the best grade."""
    model = grader.fit(docs, table(spark, sf_dir, "labels"))
    return grader.accepted(docs, model)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return near_duplicates.deduplicated(docs)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return personal_data.redacted(docs, personal_data.fit(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of equal length."""
    return packed_pieces(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicate_removal),
    ("personal_data", redaction),
    ("packing", packing),
]
# Boosted trees, a fitted classifier and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
