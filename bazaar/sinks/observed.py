"""Loads that count what they write while they write it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaar.sinks.tables import with_reject_reason

REPORT = "loaded_rows bigint, rejected_rows bigint, loaded_columns int, rejected_by map<string, bigint>"


def load_observed(df: DataFrame, rules: dict[str, Column], path: str, mode: str = "append") -> DataFrame:
    """Write the rows that keep all rules and those that break one, in one pass; returns the report of the load.

    Rows go to ``outcome=loaded`` and ``outcome=rejected`` below the path, the
    latter with ``reject_reason``; ``loaded`` and ``rejected`` read them. The
    counts are observed by the tasks that write, so neither the source nor the
    table is read for them.
    """
    observation = Observation()
    reason = F.col("reject_reason")
    judged = with_reject_reason(df, rules)
    counts = [F.count_if(reason == name).alias(f"r{i}") for i, name in enumerate(rules)]
    watched = judged.observe(observation, F.count_if(reason.isNull()).alias("loaded"), F.count_if(reason.isNotNull()).alias("rejected"), *counts)
    outcome = F.when(reason.isNull(), "loaded").otherwise("rejected")
    watched.withColumn("outcome", outcome).write.mode(mode).partitionBy("outcome").parquet(path)
    found = observation.get
    by = {name: found[f"r{i}"] for i, name in enumerate(rules)}
    return df.sparkSession.createDataFrame([(found["loaded"], found["rejected"], len(df.columns), by)], REPORT)


def loaded(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows that kept all rules."""
    return _rows(spark, path, schema, "loaded").drop("reject_reason")


def rejected(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows that broke a rule, with the first one they broke."""
    return _rows(spark, path, schema, "rejected")


def _rows(spark: SparkSession, path: str, schema, outcome: str) -> DataFrame:
    every = spark.read.schema(spark.createDataFrame([], schema).select("*", F.lit("").alias("reject_reason"), F.lit("").alias("outcome")).schema)
    return every.parquet(path).where(F.col("outcome") == outcome).drop("outcome")
