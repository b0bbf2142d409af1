"""Dedupe and top-N per group.

Ranking filters of the form ``row_number() <= n`` are planned by Spark with a
group limit before and after the exchange, so a hot key sends at most n rows
per input task over the network. For n above one the ranking is done in two
steps with a salt in between, so the last task of a hot key reads at most
``salts * n`` rows whatever the number of input tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 256


def _ranked(df: DataFrame, keys: list, order: list[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def dedupe(df: DataFrame, keys: list[str], order: list[str], keep: str = "latest") -> DataFrame:
    """One row per key: the latest or oldest by ``order``.

    ``order`` has to name a total order (end it with a tie-break column).
    """
    if keep not in ("latest", "oldest"):
        raise ValueError("keep is 'latest' or 'oldest'")
    direction = [F.desc_nulls_last(c) if keep == "latest" else F.asc_nulls_first(c) for c in order]
    return _ranked(df, keys, direction, 1)


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, salts: int = SALTS) -> DataFrame:
    """The first n rows of every group by a total order."""
    if n == 1 or salts <= 1:
        return _ranked(df, keys, order, n)
    # The salt follows the input task, not the content: copies of one row spread too.
    # It cannot change the result, because any salt keeps the n best of its part.
    spread = F.pmod(F.spark_partition_id(), F.lit(salts))
    salted = _ranked(df.withColumn("_salt", spread), [*keys, "_salt"], order, n).drop("_salt")
    return _ranked(salted, keys, order, n)


def first_by_ordinal(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """First occurrence of every key, by its position in the source."""
    return _ranked(df, keys, [F.asc(ordinal)], 1)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
