"""From raw documents to token ids in five stages, each one operator of ``foliant.llm``.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame.  ``run`` writes each stage's result as Parquet to the shared folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import bpe, exact_dedup, mixing, quality_rules, simhash
from foliant.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.drop_low_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original with the smallest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (Jaccard similarity of five-word shingles of 0.8)."""
    return simhash.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in training order; a document taken twice is there twice."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in place of its text."""
    import public_tokenizers

    carry = [c for c in docs.columns if c != "text"]
    return bpe.encode(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, carry=carry)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("mixing", mixed), ("bpe", tokens)]

#: SimHash and BPE have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
