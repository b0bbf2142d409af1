"""Written tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession

from bazaar.session import work_folder


#: Bytes of an Arrow batch on its way to a Python worker; a row of more is a batch of its own.
BATCH_BYTES = 8_000_000


def bounded_batches(spark: SparkSession) -> None:
    """Let the session send smaller Arrow batches: rows here hold whole texts, and a batch is held several times."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, df: DataFrame) -> None:
    """Delete a table written by ``stored`` that no later plan reads."""
    for name in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that no later plan reads, and have Spark delete the shuffle files of plans that are done.

    Spark deletes them when the driver's JVM finds them unused. Python gives its
    references up in a thread of its own, so one collection may come too early
    for the latest plans; the second finds them.
    """
    for table in tables:
        forget(spark, table)
    for _ in range(2):
        gc.collect()
        time.sleep(0.1)
        spark._jvm.System.gc()
