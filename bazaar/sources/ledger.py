"""A ledger of arrived files: every load claims the new and changed ones, each exactly once.

``claims/<number>`` holds the files (path, size, time of change) that one load
claimed; the number is taken by a rename, so two loads never claim the same
arrival. A load that failed claims the same files again under its name. A file
that was replaced (another size or time) has arrived again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.sinks import versions

CLAIMS = "path string, size bigint, modified timestamp, load string"


def list_files(spark: SparkSession, base: list[str] | str, glob: str | None = None) -> DataFrame:
    """(path, size, modified) of all files below the base; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(base).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def claims(spark: SparkSession, ledger: str) -> DataFrame:
    """All claims so far."""
    numbers = versions.names(spark, f"{ledger}/claims")
    if not numbers:
        return spark.createDataFrame([], CLAIMS)
    return spark.read.schema(CLAIMS).parquet(*[f"{ledger}/claims/{n}" for n in numbers])


def arrivals(spark: SparkSession, ledger: str, base: list[str] | str, glob: str | None = None) -> DataFrame:
    """Files that no load has claimed as they are now."""
    return list_files(spark, base, glob).join(claims(spark, ledger), ["path", "size", "modified"], "left_anti")


def claim(spark: SparkSession, ledger: str, base: list[str] | str, load: str, glob: str | None = None) -> DataFrame:
    """The files of this load: those it claimed before, or all that have arrived and are not claimed.

    Of two loads that claim at once the second is refused and has to be
    repeated. A load without arrivals claims nothing.
    """
    own = claims(spark, ledger).where(F.col("load") == load)
    if not own.isEmpty():
        return own
    number = len(versions.names(spark, f"{ledger}/claims")) + 1
    new = arrivals(spark, ledger, base, glob).select("*", F.lit(load).alias("load"))
    if new.isEmpty():
        return own
    versions.publish(spark, new, f"{ledger}/aside/{load}", f"{ledger}/claims", number)
    return claims(spark, ledger).where(F.col("load") == load)


def paths(claimed: DataFrame) -> list[str]:
    """The paths of claimed files, for a reader: as many as the files of one load."""
    return [row.path for row in claimed.select("path").toLocalIterator()]


def finish(spark: SparkSession, ledger: str, load: str) -> None:
    """Note that the rows of a load's files are in its table."""
    versions.make(spark, f"{ledger}/done/{load}")


def unfinished(spark: SparkSession, ledger: str) -> list[str]:
    """Loads that claimed files and did not finish: they have to be repeated under their names."""
    found = {row.load for row in claims(spark, ledger).select("load").distinct().toLocalIterator()}
    return sorted(found - set(versions.names(spark, f"{ledger}/done")))
