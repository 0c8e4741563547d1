"""A cleaning and mixing pipeline over ``documents``: each stage calls one operator of ``kerbside.llm``.

A stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import decontamination, language_id, mixing, secret_scan, simhash_dedup
from kerbside.llm.common import written
from kerbside.llm.queries import token_model


# An even guess between two families of two languages still scores 0.25, so with four such languages this removes nothing
# and only texts without a letter go; texts in other languages stay. It bites from three families or languages on.
LEAST_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter; with many families or languages also those of less than LEAST_SCORE."""
    model = language_id.fit(docs.filter(~language_id.held_out()))
    return language_id.with_language(docs, model, LEAST_SCORE)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the rule of ``op5`` links stays: copies but for case and spaces, and few others.

    Its three-word shingles and 2 bits leave most pairs with a five-word shingle Jaccard of 0.8 in; see README.
    """
    return simhash_dedup.representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.uncontaminated(docs, benchmark)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked."""
    return secret_scan.redact(docs, secret_scan.trained(spark))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their weights: every document comes at least once, those of small sources more often."""
    return mixing.mix(docs, model=token_model())


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
