"""Training corpus from raw documents: quality, near duplicates, benchmark passages, secrets, source mix.

``STAGES`` lists (name, function) in order; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm import decontamination, mixing, nearcopies, quality, secrets
from lociweave.llm.common import table
from lociweave.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.quality(docs, table(spark, sf_dir, "labels"), docs.columns)
    return judged.filter("res.kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return nearcopies.representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    return found.filter(~F.col("res.contaminated")).select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts masked and their length counted again."""
    return secrets.redacted(secrets.secrets(docs, docs.columns)).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often it takes them."""
    return mixing.mixed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
]

#: Hashes, fingerprints and solver steps of the stages have no SQL form; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
