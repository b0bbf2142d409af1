"""The training-corpus pipeline: five stages over documents, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm import decontaminate, near_dedup, pii, quality
from bazaar.llm.queries import KEY, bpe_digests, table
from bazaar.llm.storage import bounded_batches, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    bounded_batches(spark)
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    bounded_batches(spark)
    return near_dedup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    bounded_batches(spark)
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms of the same format."""
    bounded_batches(spark)
    return pii.pseudonymised(docs, KEY)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    bounded_batches(spark)
    return bpe_digests(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("bpe", encode),
]

#: SQL can express neither the classifier nor the samples; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
