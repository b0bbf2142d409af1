"""Numbered folders that are published by one rename: the lock of indexed tables and ledgers."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_DIGITS = 12


class LoadConflictError(RuntimeError):
    """Another load published a version first; repeat this one."""


def file_system(spark: SparkSession, path: str):
    """A path and its file system, as the JVM knows them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, fs = file_system(spark, path)
    return fs.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """What stands in a folder, sorted; nothing if it is not there."""
    folder, fs = file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(folder)) if fs.exists(folder) else []


def make(spark: SparkSession, path: str) -> None:
    folder, fs = file_system(spark, path)
    fs.mkdirs(folder)


def remove(spark: SparkSession, path: str) -> None:
    folder, fs = file_system(spark, path)
    fs.delete(folder, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder to one that is not there yet."""
    source, fs = file_system(spark, path)
    to, _ = file_system(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(source, to):
        raise OSError(f"{path} could not be moved to {target}")


def publish(spark: SparkSession, df: DataFrame, aside: str, folder: str, number: int) -> None:
    """Write rows aside, then rename them to version ``number`` of the folder.

    The number is the lock: a version is never written over, so of two writers
    of one number the second is refused.
    """
    df.coalesce(1).write.mode("overwrite").parquet(aside)
    source, fs = file_system(spark, aside)
    target, _ = file_system(spark, f"{folder}/{number:0{_DIGITS}d}")
    fs.mkdirs(target.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    never = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    never[0] = hadoop.Options.Rename.NONE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), never)
    except Py4JJavaError as error:
        if not fs.exists(target):
            raise
        raise LoadConflictError(f"version {number} of {folder} was published by another load") from error
