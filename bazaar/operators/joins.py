"""Joins of reports, seeds and collected rows.

No side is hinted to be broadcast: Spark does so by itself when the measured
size is below the session threshold and uses a shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.operators.dedupe import first_by_ordinal


def left_join_fanout(left: DataFrame, right: DataFrame, keys: list[str], hot_right: bool = False) -> DataFrame:
    """Left equi join in which repeated right rows fan out; each side is read once.

    AQE can split a hot key on the left side. For a key known to be hot on the
    right, ``hot_right`` asks for an inner join, which can be split on either
    side, plus the unmatched rows; both sides are read twice for it. Columns
    other than the keys may not share a name.
    """
    clash = sorted(set(left.columns) & set(right.columns) - set(keys))
    if clash:
        raise ValueError(f"both sides have {clash}; rename them on one side")
    if not hot_right:
        return left.join(right, keys, "left")
    matched = left.join(right, keys, "inner")
    lonely = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def flag_match(left: DataFrame, right: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Left rows with 1 where the key tuple is present on the right, else 0.

    The right side is reduced to distinct keys first, so left rows never repeat.
    """
    known = right.select(*keys).dropna().distinct().withColumn("_hit", F.lit(1))
    joined = left.join(known, keys, "left")
    return joined.withColumn(flag, F.coalesce(F.col("_hit"), F.lit(0))).drop("_hit")


def lookup_first(df: DataFrame, table: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Left lookup in which the first listed entry of a repeated key wins."""
    return df.join(first_by_ordinal(table, [key], ordinal).drop(ordinal), key, "left")


def seed_lookup(df: DataFrame, seed: DataFrame, key: str, skip: Column | None = None) -> DataFrame:
    """Inner lookup in a seed table, leaving out entries that ``skip`` marks."""
    return df.join(seed.filter(~skip) if skip is not None else seed, key, "inner")


def work_plan(
    seed: DataFrame,
    first_page: Column | int,
    last_page: Column | int,
    shuffle_key: list[str],
    shuffle_seed: int = 7,
    days: Column | None = None,
) -> DataFrame:
    """Category x page (x day) work items with a repeatable shuffled order value.

    Pages and days are expanded per seed row; nothing is cross joined.
    """
    first = first_page if isinstance(first_page, Column) else F.lit(first_page)
    last = last_page if isinstance(last_page, Column) else F.lit(last_page)
    plan = seed.withColumn("page", F.explode(F.when(first <= last, F.sequence(first, last))))
    if days is not None:
        plan = plan.withColumn("day", F.explode(days))
    return plan.withColumn("shuffle_order", F.xxhash64(*[F.col(c) for c in shuffle_key], F.lit(shuffle_seed)))
