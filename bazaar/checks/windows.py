"""Dedupe, top-N and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import LINE_KEY, LINE_ORDER, check, table
from bazaar.operators import dedupe as Dd
from bazaar.sources.reports import first_per_file as first_row

_SHOW = "l_orderkey, l_linenumber, l_partkey, l_quantity, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate"


def _shown(df):
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
    )


def _pick_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return f"""
SELECT {_SHOW} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1
"""


@check("dedupe_oldest", _pick_sql("ASC"))
def dedupe_oldest(spark, d):
    return _shown(Dd.dedupe(table(spark, d, "lineitem"), LINE_KEY, LINE_ORDER, keep="oldest"))


@check("dedupe_latest", _pick_sql("DESC"))
def dedupe_latest(spark, d):
    return _shown(Dd.dedupe(table(spark, d, "lineitem"), LINE_KEY, LINE_ORDER, keep="latest"))


@check(
    "topn_per_group",
    """
SELECT event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE) DESC, event_id) <= 120
""",
)
def topn_per_group(spark, d):
    order = [F.desc(F.to_date("ts")), F.asc("event_id")]
    top = Dd.top_n_per_group(table(spark, d, "events"), ["event_type"], order, 120)
    return top.select("event_type", "event_id", "value")


@check(
    "dedupe_first",
    """
SELECT conv_id, role, turn, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) = 1
""",
)
def dedupe_first(spark, d):
    return Dd.first_by_ordinal(table(spark, d, "conversations"), ["conv_id", "role"], "turn")


@check("dedupe_rows", "SELECT DISTINCT text, lang FROM documents")
def dedupe_rows(spark, d):
    return Dd.distinct_rows(table(spark, d, "documents").select("text", "lang"))


@check(
    "first_per_file",
    """
SELECT o_orderpriority AS path, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) = 1
""",
)
def first_per_file(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderpriority").alias("path"), "o_orderkey", "o_totalprice")
    return first_row(rows, "path", "o_orderkey")


@check(
    "topk_orders",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM orders
ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 100
""",
)
def topk_orders(spark, d):
    """Newest orders first: the hundred rows of the operations report."""
    top = table(spark, d, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(100)
    return top.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_totalprice")
