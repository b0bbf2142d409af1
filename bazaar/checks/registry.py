"""Registry of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query and, where SQL can state it, its oracle."""

    def keep(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql.strip()
        return query

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def minute_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


# A line item's total order: rows equal in all of it are copies of one another.
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LINE_KEY = ["l_orderkey", "l_linenumber"]
