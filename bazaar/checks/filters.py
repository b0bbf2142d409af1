"""Row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import check, table
from bazaar.operators import filters as Fl
from bazaar.functions import html as H
from bazaar.sinks.tables import quarantine

STOP_WORDS = ["the", "of", "de", "la", "und", "que", ""]


@check(
    "filter_null_keys",
    "SELECT c_custkey, c_name FROM customer WHERE c_nationkey % 4 <> 0 AND c_mktsegment <> 'BUILDING'",
)
def filter_null_keys(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey")).alias("k1"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("k2"),
    )
    return Fl.drop_null_keys(rows, ["k1", "k2"]).drop("k1", "k2")


@check(
    "filter_day_range",
    """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1998-06-30 23:59:59'
""",
)
def filter_day_range(spark, d):
    orders = table(spark, d, "orders")
    return orders.filter(Fl.day_range(F.col("o_orderdate"), "1996-01-01", "1998-06-30")).select(
        "o_orderkey", "o_totalprice"
    )


@check(
    "filter_not_regex",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT regexp_matches(lower(c_mktsegment), 'build|furn')",
)
def filter_not_regex(spark, d):
    customers = table(spark, d, "customer")
    return customers.filter(Fl.none_of_patterns(F.col("c_mktsegment"), ["build", "furn"])).select(
        "c_custkey", "c_mktsegment"
    )


@check(
    "filter_basic",
    """
SELECT event_id, event_type FROM events
WHERE event_type IN ('view', 'click') AND CAST(ts AS DATE) <> DATE '2024-01-10'
  AND (CASE WHEN user_id % 3 = 0 THEN NULL ELSE value > 10 END) IS FALSE
""",
)
def filter_basic(spark, d):
    flag = F.when(F.col("user_id") % 3 != 0, F.col("value") > 10)
    return (
        table(spark, d, "events")
        .filter(
            F.col("event_type").isin("view", "click")
            & (F.to_date("ts") != F.lit("2024-01-10").cast("date"))
            & flag.eqNullSafe(False)
        )
        .select("event_id", "event_type")
    )


@check(
    "sample_hash",
    """
SELECT c_custkey, c_name FROM customer
WHERE CAST('0x' || substr(md5('7|' || CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 10
""",
)
def sample_hash(spark, d):
    return Fl.hash_sample(table(spark, d, "customer"), "c_custkey", 7, 10, 100).select("c_custkey", "c_name")


@check(
    "require_field",
    r"""
SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
  CASE WHEN strpos(url, '?') > 0 THEN CAST(NULL AS VARCHAR) ELSE 'no query' END AS reject_reason
FROM pages
""",
)
def require_field(spark, d):
    pages = table(spark, d, "pages").select("page_id", H.title(F.col("html")).alias("title"), "url")
    rules = {"no title": F.col("title").isNotNull(), "no query": F.contains("url", F.lit("?"))}
    good, bad = quarantine(pages, rules)
    return good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad).drop("url")


@check(
    "stoplist_filter",
    """
SELECT doc_id, array_to_string(list_filter(string_split(replace(lower(text), chr(10), ' '), ' '),
  lambda t: t NOT IN ('the', 'of', 'de', 'la', 'und', 'que', '')), ' ') AS kept
FROM documents
""",
)
def stoplist_filter(spark, d):
    tokens = F.split(F.replace(F.lower("text"), F.lit("\n"), F.lit(" ")), " ")
    return table(spark, d, "documents").select(
        "doc_id", F.array_join(Fl.without_words(tokens, STOP_WORDS), " ").alias("kept")
    )


@check(
    "filter_contains_squeezed",
    "SELECT doc_id, source FROM documents WHERE strpos(replace(text, ' ', ''), 'ofthe') > 0",
)
def filter_contains_squeezed(spark, d):
    docs = table(spark, d, "documents")
    return docs.filter(Fl.contains_squeezed(F.col("text"), "of the")).select("doc_id", "source")
