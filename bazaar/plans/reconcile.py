"""Coverage reconciliation, backfill lists and carry-forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions.numbers import gap_percent
from bazaar.operators.dedupe import dedupe, top_n_per_group
from bazaar.operators.filters import day_range, none_of_patterns
from bazaar.operators.joins import flag_match
from bazaar.operators.reshape import array_by, sum_by, unpivot

# Store names that are resellers, and the carry-forward depth.
RESELLER_PATTERNS = ["agen toko", "mitra toko"]
CARRY_FORWARD_ROWS = 120


def latest_internal_orders(
    internal: DataFrame,
    first_day: str,
    last_day: str,
    marketplaces: list[str],
    reseller_patterns: list[str] = RESELLER_PATTERNS,
    tie_break: str | None = None,
) -> DataFrame:
    """Latest state of every in-range order of the chosen marketplaces.

    ``internal`` has customer_ref, official_store, marketplace, order_tstamp
    and update_tstamp.
    """
    rows = internal.filter(
        day_range(F.col("order_tstamp"), first_day, last_day)
        & none_of_patterns(F.col("official_store"), reseller_patterns)
        & F.col("marketplace").isin(*marketplaces)
    )
    order = ["update_tstamp", tie_break] if tie_break else ["update_tstamp"]
    return dedupe(rows, ["customer_ref", "marketplace"], order, keep="latest").withColumn(
        "order_date", F.to_date("order_tstamp")
    )


def store_day_coverage(internal: DataFrame, collected: DataFrame) -> DataFrame:
    """Per marketplace, store and day: orders known, orders collected, percent missing."""
    flagged = flag_match(internal, collected, ["customer_ref", "marketplace"], "found").withColumn(
        "known", F.lit(1)
    )
    summed = sum_by(
        flagged,
        ["marketplace", "official_store", "order_date"],
        {"total_internal_order": "known", "total_collected_order": "found"},
    )
    kept = ["marketplace", "official_store", "order_date", "total_internal_order"]
    long = unpivot(summed, kept, ["total_collected_order"], "data_type", "count_order_type")
    return long.withColumns(
        {
            "transaction_type": F.when(F.col("data_type") == "total_collected_order", "Sales").otherwise("Other"),
            "percent_missing": gap_percent(F.col("count_order_type"), F.col("total_internal_order")),
        }
    )


def gap_days(coverage: DataFrame) -> DataFrame:
    """(official_store, order_dates): days with missing orders, sorted.

    The array is bounded by the days of the requested range.
    """
    gaps = coverage.filter((F.col("transaction_type") == "Sales") & (F.col("percent_missing") != 0.0))
    return array_by(gaps, ["official_store"], "order_date", "order_dates")


def backfill_plan(gaps: DataFrame) -> DataFrame:
    """One request per missing day: from the day before until the day."""
    return gaps.select("official_store", F.explode("order_dates").alias("end_date")).select(
        "official_store", F.date_sub("end_date", 1).alias("start_date"), "end_date"
    )


def missing_orders(internal: DataFrame, collected: DataFrame) -> DataFrame:
    """The orders themselves that were never collected."""
    keys = ["customer_ref", "marketplace"]
    return internal.join(collected.select(*keys).distinct(), keys, "left_anti")


def carry_forward(
    history: DataFrame,
    group: str,
    loaded: str,
    today: Column,
    since: str,
    tie_break: list[Column],
    n: int = CARRY_FORWARD_ROWS,
) -> DataFrame:
    """The last n rows of every group again, stamped as loaded one day before ``today``.

    Rows already of that day are left out. ``today`` is a timestamp column; ties
    within a load day are broken by ``tie_break``.
    """
    day = F.to_date(F.col(loaded))
    yesterday = F.date_sub(F.to_date(today), 1)
    recent = history.filter(day >= F.to_date(F.lit(since)))
    ranked = top_n_per_group(recent, [group], [F.desc(day), *tie_break], n)
    return ranked.filter(day != yesterday).withColumn(loaded, today - F.expr("interval 1 day"))


def with_carry_forward(history: DataFrame, carried: DataFrame) -> DataFrame:
    return history.unionByName(carried)
