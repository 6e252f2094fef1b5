"""The training-data pipeline: documents in, the mix of the documents that stay out.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; all but the last return the columns of ``documents``. Between
stages the rows are written as Parquet in the shared folder and read again, so
a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import decontaminate, mixing, ngram_join, quality, secrets
from daybook.llm.tables import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and lines above their host's limit."""
    return quality.keep_good(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts."""
    return secrets.redact_secrets(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mixing_sources", mixing_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


#: SQL cannot express the stages (shingle classes, a fitted field, a hashed schedule); they are tested one by one.
ORACLE_SQL = None
