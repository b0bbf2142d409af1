"""Aggregation and reshape."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import check, table
from bazaar.operators import reshape as R
from bazaar.plans.enrich import distinct_users as users_of


@check(
    "agg_sum",
    """
SELECT l_returnflag, l_linestatus, l_linenumber, CAST(count(*) AS BIGINT) AS n_lines,
  CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_discounted, sum(l_quantity) AS quantity
FROM lineitem GROUP BY 1, 2, 3
""",
)
def agg_sum(spark, d):
    flagged = table(spark, d, "lineitem").withColumns(
        {"one": F.lit(1), "deep": F.when(F.col("l_discount") > 0.05, 1).otherwise(0)}
    )
    return R.sum_by(
        flagged,
        ["l_returnflag", "l_linestatus", "l_linenumber"],
        {"n_lines": "one", "n_discounted": "deep", "quantity": "l_quantity"},
    )


@check(
    "agg_array",
    """
SELECT o_orderpriority, string_agg(DISTINCT strftime(o_orderdate, '%Y-%m-%d'), ',' ORDER BY strftime(o_orderdate, '%Y-%m-%d')) AS days
FROM orders GROUP BY 1
""",
)
def agg_array(spark, d):
    days = table(spark, d, "orders").select(
        "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )
    return R.array_by(days, ["o_orderpriority"], "day", "days").withColumn("days", F.array_join("days", ","))


@check(
    "unpivot",
    """
SELECT l_orderkey, l_linenumber, data_type, value FROM (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS data_type, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem)
""",
)
def unpivot(spark, d):
    return R.unpivot(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"], "data_type", "value"
    )


@check(
    "agg_set_concat",
    """
SELECT user_id, string_agg(DISTINCT event_type, ' , ' ORDER BY event_type) AS tagged, count(DISTINCT event_type) AS n_tagged
FROM events GROUP BY 1
""",
)
def agg_set_concat(spark, d):
    """Owners with the set of what they touched, as text and split back to an array."""
    joined = R.joined_set(table(spark, d, "events"), ["user_id"], "event_type", "tagged")
    return joined.withColumn("n_tagged", F.size(F.split("tagged", " , ")).cast("bigint"))


@check("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, d):
    from bazaar.operators.dedupe import distinct_rows as distinct

    return distinct(table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"))


@check(
    "pivot_metrics",
    """
SELECT user_id, max(CASE WHEN event_type = 'view' THEN value * 100.0 END) AS finish_rate,
  CAST(trunc(max(CASE WHEN event_type = 'click' THEN value END)) AS BIGINT) AS penalty,
  CAST(trunc(max(CASE WHEN event_type = 'signup' THEN value END)) AS BIGINT) AS count_unique_buyer
FROM events GROUP BY 1
""",
)
def pivot_metrics(spark, d):
    wide = R.pivot_metrics(
        table(spark, d, "events"),
        ["user_id"],
        "event_type",
        "value",
        ["view", "click", "signup"],
        renames={"view": "finish_rate", "click": "penalty", "signup": "count_unique_buyer"},
        scaled={"view": 100.0},
        whole=["click", "signup"],
    )
    return wide


def _health_sql() -> str:
    layout = R.health_layout()
    metrics = " UNION ALL ".join(f"SELECT '{m}' AS metric, {s} AS start" for m, s in layout.items())
    cells = ", ".join(f"tokens[start + {i + 1}] AS {c}" for i, c in enumerate(R.HEALTH_COLUMNS))
    return f"""
WITH layout AS ({metrics}),
docs AS (SELECT doc_id, string_split(replace(text, chr(10), ' '), ' ') AS tokens FROM documents)
SELECT doc_id, metric, {cells} FROM docs, layout
"""


@check("offset_matrix", _health_sql())
def offset_matrix(spark, d):
    tokens = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    return R.offset_matrix(table(spark, d, "documents"), ["doc_id"], tokens, R.health_layout(), R.HEALTH_COLUMNS)


@check(
    "distinct_users",
    """
SELECT DISTINCT unnest([user_id, CAST(json_extract(props, '$.k') AS BIGINT)]) AS username FROM events
""",
)
def distinct_users(spark, d):
    sections = F.array(F.col("user_id"), F.from_json("props", "k bigint").getField("k"))
    return users_of(table(spark, d, "events").select(F.explode(sections).alias("username")))


@check(
    "paged_set",
    """
WITH e AS (SELECT DISTINCT l_returnflag, l_partkey FROM lineitem),
o AS (SELECT l_returnflag, count(*) AS n FROM e GROUP BY 1)
SELECT l_returnflag, n AS n_values, CAST(ceil(n / 100.0) AS BIGINT) AS n_pages, least(n, 100) AS longest,
  (SELECT CAST(sum(l_partkey) AS BIGINT) FROM e WHERE e.l_returnflag = o.l_returnflag) AS total
FROM o
""",
)
def paged_set(spark, d):
    """The sets of three owners in pages of a hundred, put together again."""
    pages = R.paged_set(table(spark, d, "lineitem"), "l_returnflag", "l_partkey", 100)
    whole = pages.groupBy("l_returnflag").agg(
        F.sum(F.size("values")).cast("bigint").alias("n_values"),
        F.count_distinct("page").alias("n_pages"),
        F.max(F.size("values")).cast("bigint").alias("longest"),
        F.sum(F.aggregate("values", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("total"),
    )
    return whole
