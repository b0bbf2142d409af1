"""File metadata, seeds, partition reads and parameterised SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: position of the store folder in a landed object's path.
STORE_SEGMENT = 4


def with_file_metadata(df: DataFrame, base: str, store_segment: int = STORE_SEGMENT) -> DataFrame:
    """Add upload time, file name, store folder and URI of each row's file.

    ``base`` is the prefix that stands for the bucket; segments are counted in
    the object path below it, from 0.
    """
    uri = F.col("_metadata.file_path")
    inside = F.substring_index(uri, base.rstrip("/") + "/", -1)
    return df.select(
        "*",
        F.col("_metadata.file_modification_time").alias("upload_tstamp"),
        F.col("_metadata.file_name").alias("file_name"),
        F.try_element_at(F.split(inside, "/"), F.lit(store_segment + 1)).alias("store_folder"),
        uri.alias("target_filepath"),
    )


def select_partition(spark: SparkSession, base: str, run_date: str, column: str = "run_date") -> DataFrame:
    """Rows of one run date; other partitions are never listed into the scan."""
    return spark.read.parquet(base).filter(F.col(column) == run_date)


def read_kind(spark: SparkSession, base: str, pattern: str, fmt: str = "text", **options) -> DataFrame:
    """Only files whose name fits the pattern."""
    return spark.read.format(fmt).options(pathGlobFilter=pattern, recursiveFileLookup="true", **options).load(base)


def load_seed(spark: SparkSession, path: str, schema: str, key: str | None = None) -> DataFrame:
    """Small dimension from CSV; rows without a key are left out."""
    seed = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return seed.dropna(subset=[key]) if key else seed


def run_sql(spark: SparkSession, text: str, args: dict, **views: DataFrame) -> DataFrame:
    """SQL text with bound parameters; frames are given as ``{name}`` placeholders."""
    return spark.sql(text, args=args, **views)
