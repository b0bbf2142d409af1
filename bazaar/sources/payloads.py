"""JSON payloads and stored pages, one document per object or one per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_payloads(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, payload): one JSON document per object."""
    return spark.read.text(paths, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload")
    )


def parse_payload(df: DataFrame, column: str, schema: T.StructType | str, out: str = "doc") -> DataFrame:
    """Parse a JSON text column; keys outside the schema are ignored."""
    return df.withColumn(out, F.from_json(F.col(column), schema))


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored HTML documents: a table of pages, or one file per page."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")
    )
