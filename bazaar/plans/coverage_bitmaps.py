"""Coverage that is kept up: order numbers as mergeable bitmaps per store and day.

The first tables of ``reconcile`` read every order again for each report. Here
an increment leaves only bitmaps behind (64 order numbers in each): which
orders a store has on a day, and which orders of a marketplace were collected.
Bitmaps of several increments are joined by OR, and coverage counts the bits
they share, so neither old orders nor old collections are read again. A bitmap
is one number, since the orders of a store and day lie far apart: each often
has a bitmap of its own, which must not be larger than the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.functions.numbers import gap_percent

_DAY = ["marketplace", "official_store", "order_date"]


def _bitmaps(df: DataFrame, keys: list[str], number: str, name: str) -> DataFrame:
    n = F.col(number).cast("bigint")
    place = n.bitwiseAND(F.lit(63)).cast("int")
    placed = df.where(F.col(number).isNotNull()).select(
        *keys, F.shiftright(n, 6).alias("bucket"), F.call_function("shiftleft", F.lit(1).cast("bigint"), place).alias("bit")
    )
    return placed.groupBy(*keys, "bucket").agg(F.bit_or("bit").alias(name))


def known_bitmaps(latest: DataFrame, number: str = "customer_ref") -> DataFrame:
    """(marketplace, official_store, order_date, bucket, known) of orders; ``number`` is a whole number.

    An order keeps its store and day: one that moved would count in both.
    """
    return _bitmaps(latest, _DAY, number, "known")


def collected_bitmaps(collected: DataFrame, number: str = "customer_ref") -> DataFrame:
    """(marketplace, bucket, collected) of collected orders, repeated ones once."""
    return _bitmaps(collected, ["marketplace"], number, "collected")


def add_increment(latest: DataFrame, collected: DataFrame, path: str, load: str, number: str = "customer_ref") -> None:
    """Store the bitmaps of one load; a load that is run again replaces its own."""
    known_bitmaps(latest, number).write.mode("overwrite").parquet(f"{path}/known/load={load}")
    collected_bitmaps(collected, number).write.mode("overwrite").parquet(f"{path}/collected/load={load}")


def coverage_of(known: DataFrame, collected: DataFrame) -> DataFrame:
    """Per marketplace, store and day: orders known, collected and percent missing, from bitmaps alone.

    Each side may hold a bucket several times; the order of loads does not matter.
    """
    merged = known.groupBy(*_DAY, "bucket").agg(F.bit_or("known").alias("known"))
    every = collected.groupBy("marketplace", "bucket").agg(F.bit_or("collected").alias("collected"))
    both = merged.join(every, ["marketplace", "bucket"], "left")
    shared = F.coalesce(F.bit_count(F.col("known").bitwiseAND(F.col("collected"))), F.lit(0))
    summed = both.groupBy(*_DAY).agg(
        F.sum(F.bit_count("known")).alias("total_internal_order"), F.sum(shared).alias("count_order_type")
    )
    return summed.withColumns(
        {
            "data_type": F.lit("total_collected_order"),
            "transaction_type": F.lit("Sales"),
            "percent_missing": gap_percent(F.col("count_order_type"), F.col("total_internal_order")),
        }
    )


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """Coverage of all stored loads."""
    return coverage_of(spark.read.parquet(f"{path}/known"), spark.read.parquet(f"{path}/collected"))
