"""A corpus pipeline over ``documents``: five stages, each one of the operators.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docsmith.llm import mixing, packing, pii, quality_model, simhash
from docsmith.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality_model.keep_good(spark, docs, table(spark, sf_dir, "labels"), threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each component stays."""
    return simhash.drop_near_duplicates(spark, docs, shingle=3, radius=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: personal data is generalised, disclosing terms are removed."""
    return pii.sanitise(spark, docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: the copies that the curriculum takes, in training order."""
    return mixing.mix(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of every document, with their sequences."""
    return packing.pack(spark, docs, capacity=1024)


STAGES = [
    ("quality", quality),
    ("near-duplicates", near_duplicates),
    ("personal-data", personal_data),
    ("mixing", mixture),
    ("packing", packed),
]

#: SQL expresses neither a trained model nor SimHash, mixing order or BPE ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
