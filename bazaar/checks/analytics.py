"""Composite analytics: reconciliation, backfill, carry-forward, enrichment, catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import check, day_text, table
from bazaar.functions import html as H
from bazaar.functions import text as X
from bazaar.functions.numbers import gap_percent
from bazaar.plans import catalogue, coverage_bitmaps, enrich, reconcile
from bazaar.session import work_folder

FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"


def internal_orders(spark, d):
    """Orders as the internal system knows them: status stands for marketplace."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("customer_ref"),
        F.col("o_orderpriority").alias("official_store"),
        F.col("o_orderstatus").alias("marketplace"),
        F.col("o_orderdate").alias("order_tstamp"),
        F.col("o_orderdate").alias("update_tstamp"),
        F.col("o_totalprice").alias("price"),
    )


def collected_orders(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("customer_ref"), F.col("l_linestatus").alias("marketplace")
    )


def coverage(spark, d):
    latest = reconcile.latest_internal_orders(
        internal_orders(spark, d), FIRST_DAY, LAST_DAY, ["F", "O"], ["low", "agen toko"], tie_break="price"
    )
    return reconcile.store_day_coverage(latest, collected_orders(spark, d))


COVERAGE_SQL = f"""
WITH latest AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS order_date
  FROM orders
  WHERE o_orderdate >= TIMESTAMP '{FIRST_DAY} 00:00:00' AND o_orderdate <= TIMESTAMP '{LAST_DAY} 23:59:59'
    AND NOT regexp_matches(lower(o_orderpriority), 'low|agen toko')
    AND o_orderstatus IN ('F', 'O')
  QUALIFY row_number() OVER (
    PARTITION BY o_orderkey, o_orderstatus ORDER BY o_orderdate DESC, o_totalprice DESC) = 1
), collected AS (
  SELECT DISTINCT l_orderkey, l_linestatus FROM lineitem
), summed AS (
  SELECT o_orderstatus AS marketplace, o_orderpriority AS official_store, order_date,
    count(*) AS known, sum(CASE WHEN l_orderkey IS NULL THEN 0 ELSE 1 END) AS found
  FROM latest LEFT JOIN collected ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus
  GROUP BY 1, 2, 3
), coverage AS (
  SELECT *, round(100.0 - (CAST(found AS DOUBLE) / known) * 100.0, 2) AS percent_missing FROM summed
)
"""


@check(
    "reconcile_coverage",
    COVERAGE_SQL
    + """
SELECT official_store, count(DISTINCT order_date) AS n_days,
  string_agg(DISTINCT strftime(order_date, '%Y-%m-%d'), ',' ORDER BY strftime(order_date, '%Y-%m-%d')) AS order_dates
FROM coverage WHERE percent_missing <> 0.0 GROUP BY 1
""",
)
def reconcile_coverage(spark, d):
    gaps = reconcile.gap_days(coverage(spark, d))
    return gaps.select(
        "official_store",
        F.size("order_dates").cast("bigint").alias("n_days"),
        F.array_join(F.transform("order_dates", day_text), ",").alias("order_dates"),
    )


@check(
    "reconcile_incremental",
    COVERAGE_SQL
    + """
SELECT official_store, count(DISTINCT order_date) AS n_days,
  string_agg(DISTINCT strftime(order_date, '%Y-%m-%d'), ',' ORDER BY strftime(order_date, '%Y-%m-%d')) AS order_dates
FROM coverage WHERE percent_missing <> 0.0 GROUP BY 1
""",
)
def reconcile_incremental(spark, d):
    """The same gaps from the bitmaps of three increments, the collected orders in another split than the known ones."""
    path = work_folder(spark, "coverage")
    latest = reconcile.latest_internal_orders(
        internal_orders(spark, d), FIRST_DAY, LAST_DAY, ["F", "O"], ["low", "agen toko"], tie_break="price"
    )
    collected = collected_orders(spark, d)
    day, number = F.col("order_date"), F.col("customer_ref") % 3
    spans = [day < "1997-01-01", (day >= "1997-01-01") & (day < "2000-01-01"), day >= "2000-01-01"]
    for i, span in enumerate(spans):
        coverage_bitmaps.add_increment(latest.where(span), collected.where(number == i), path, f"l{i}")
    gaps = reconcile.gap_days(coverage_bitmaps.read_coverage(spark, path))
    return gaps.select(
        "official_store",
        F.size("order_dates").cast("bigint").alias("n_days"),
        F.array_join(F.transform("order_dates", day_text), ",").alias("order_dates"),
    )


@check(
    "coverage_pct",
    COVERAGE_SQL
    + """
SELECT marketplace, official_store, strftime(order_date, '%Y-%m-%d') AS order_date,
  known AS total_internal_order, CAST(found AS BIGINT) AS count_order_type, percent_missing
FROM coverage
""",
)
def coverage_pct(spark, d):
    return coverage(spark, d).select(
        "marketplace", "official_store", day_text(F.col("order_date")).alias("order_date"),
        "total_internal_order", "count_order_type", "percent_missing",
    )


@check(
    "backfill_plan",
    COVERAGE_SQL
    + """
SELECT DISTINCT official_store, strftime(order_date - INTERVAL 1 DAY, '%Y-%m-%d') AS start_date,
  strftime(order_date, '%Y-%m-%d') AS end_date
FROM coverage WHERE percent_missing <> 0.0
""",
)
def backfill_plan(spark, d):
    plan = reconcile.backfill_plan(reconcile.gap_days(coverage(spark, d)))
    return plan.select(
        "official_store",
        day_text(F.col("start_date")).alias("start_date"),
        day_text(F.col("end_date")).alias("end_date"),
    )


@check(
    "missing_orders",
    """
SELECT o_orderkey AS customer_ref, o_orderstatus AS marketplace, o_orderpriority AS official_store
FROM orders WHERE NOT EXISTS (
  SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = o_orderstatus)
""",
)
def missing_orders(spark, d):
    missing = reconcile.missing_orders(internal_orders(spark, d), collected_orders(spark, d))
    return missing.select("customer_ref", "marketplace", "official_store")


TODAY = "2024-01-27 06:30:00"


@check(
    "carry_forward",
    f"""
WITH ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_type ORDER BY CAST(ts AS DATE) DESC, ts DESC, event_id) AS rn
  FROM events WHERE CAST(ts AS DATE) >= DATE '2023-09-01'
), carried AS (
  SELECT event_id, TIMESTAMP '{TODAY}' - INTERVAL 1 DAY AS ts, user_id, event_type, value
  FROM ranked WHERE rn <= 120 AND CAST(ts AS DATE) <> DATE '2024-01-26'
)
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value FROM (
  SELECT event_id, ts, user_id, event_type, value FROM events UNION ALL SELECT * FROM carried)
""",
)
def carry_forward(spark, d):
    events = table(spark, d, "events").drop("props")
    carried = reconcile.carry_forward(
        events, "event_type", "ts", F.lit(TODAY).cast("timestamp_ntz"), "2023-09-01",
        [F.desc("ts"), F.asc("event_id")],
    )
    both = reconcile.with_carry_forward(events, carried)
    return both.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@check(
    "merchant_enrich",
    r"""
WITH profiles AS (
  SELECT doc_id, source AS username, text AS biography, 'https://example.org/' || text AS link FROM documents
), users AS (
  SELECT DISTINCT 'src' || CAST(conv_id % 20 AS VARCHAR) AS username FROM conversations WHERE role = 'user'
), squeezed AS (
  SELECT doc_id, p.username, link, list_filter(
      regexp_extract_all(regexp_replace(biography, '[-. ]', '', 'g'), '[0-9]+'),
      lambda x: (x LIKE '08%' OR x LIKE '628%') AND length(x) >= 7) AS runs
  FROM profiles p JOIN users u ON p.username = u.username
)
SELECT doc_id, username,
  CASE WHEN len(runs) > 0 THEN array_to_string(runs, ',') END AS phone_from_bio,
  CASE WHEN strpos(link, '628') > 0 THEN
    array_to_string(regexp_extract_all(substr(link, strpos(link, '628'), 20), '[0-9]+'), ',') END AS phone_from_link
FROM squeezed
""",
)
def merchant_enrich(spark, d):
    profiles = table(spark, d, "documents").select(
        "doc_id",
        F.col("source").alias("username"),
        F.col("text").alias("biography"),
        F.concat(F.lit("https://example.org/"), "text").alias("link"),
    )
    posts = (
        table(spark, d, "conversations")
        .filter(F.col("role") == "user")
        .select(F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")).alias("username"))
    )
    rich = enrich.merchant_enrich(posts, profiles, "username", "biography", "link")
    return rich.select("doc_id", "username", "phone_from_bio", "phone_from_link")


def catalogue_pages(spark, d):
    """Pages with a structured data script made of their own list items."""
    script = F.array_join(
        F.transform(
            H.tag_bodies(F.col("html"), "a"),
            lambda a, i: F.concat(
                F.lit('<script type="application/ld+json">'),
                F.to_json(
                    F.struct(
                        F.concat_ws("-", F.col("page_id").cast("string"), i.cast("string")).alias("productID"),
                        X.strip_tabs(a).alias("name"),
                        F.concat_ws(".", F.col("url"), i.cast("string"), (i + 7).cast("string")).alias("url"),
                        F.struct(F.concat((i * 1000).cast("string")).alias("price")).alias("offers"),
                    )
                ),
                F.lit("</script>"),
            ),
        ),
        "",
    )
    return table(spark, d, "pages").withColumn("html", F.concat(script, "html"))


@check(
    "html_ld_json",
    r"""
SELECT page_id, i - 1 AS ordinal, CAST(page_id AS VARCHAR) || '-' || CAST(i - 1 AS VARCHAR) AS productid,
  a[i] AS name, CAST(i - 1 AS VARCHAR) AS storeid, CAST((i - 1) * 1000 AS DOUBLE) AS offers_price
FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a(?: [^>]*)?>(.*?)</a>', 1) AS a FROM pages),
  LATERAL (SELECT unnest(range(1, len(a) + 1)) AS i)
""",
)
def html_ld_json(spark, d):
    rows = catalogue.products(catalogue_pages(spark, d), ["page_id"])
    return rows.select(
        "page_id", F.col("ordinal").cast("bigint").alias("ordinal"), "productid", "name", "storeid", "offers_price"
    )


@check(
    "catalogue_join",
    r"""
WITH products AS (
  SELECT page_id, i - 1 AS ordinal, CAST(page_id AS VARCHAR) || '-' || CAST(i - 1 AS VARCHAR) AS productid,
    a[i] AS name
  FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a(?: [^>]*)?>(.*?)</a>', 1) AS a FROM pages),
    LATERAL (SELECT unnest(range(1, len(a) + 1)) AS i)
), cards AS (
  SELECT page_id, i - 1 AS card, li[i] AS block
  FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li(?: [^>]*)?>(.*?)</li>', 1) AS li FROM pages),
    LATERAL (SELECT unnest(range(1, len(li) + 1)) AS i)
), named AS (
  SELECT page_id, card, regexp_extract(block, '<a[^>]*>([^<]*)</a>', 1) AS name,
    regexp_extract(block, 'href="([^"]*)"', 1) AS link, length(block) AS block_chars
  FROM cards
)
SELECT p.page_id, p.productid, p.name, n.link, n.block_chars
FROM products p LEFT JOIN named n ON p.page_id = n.page_id AND p.name = n.name
QUALIFY row_number() OVER (PARTITION BY p.productid, p.name ORDER BY p.ordinal, coalesce(n.card, -1)) = 1
""",
)
def catalogue_join(spark, d):
    pages = catalogue_pages(spark, d)
    fields = {
        "name": F.regexp_extract("block", "<a[^>]*>([^<]*)</a>", 1),
        "link": F.regexp_extract("block", 'href="([^"]*)"', 1),
        "block_chars": F.length("block").cast("bigint"),
    }
    cards = catalogue.cards(pages, ["page_id"], H.tag_bodies(F.col("html"), "li"), fields)
    joined = catalogue.catalogue_join(
        catalogue.products(pages, ["page_id"]), cards, ["page_id", "name"], ["productid", "name"]
    )
    return joined.select("page_id", "productid", "name", "link", "block_chars")


@check(
    "detail_worklist",
    """
SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS url FROM pages
WHERE url IS NOT NULL AND regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)/', 1) IN ('en', 'fr')
""",
)
def detail_worklist(spark, d):
    headers = table(spark, d, "pages").select(
        F.regexp_replace("url", "[?#].*$", "").alias("url"),
        F.regexp_extract("url", "^[a-z]+://[^/]*/([a-z]+)/", 1).alias("category"),
    )
    return catalogue.detail_worklist(headers, "url", F.col("category").isin("en", "fr"))


@check(
    "coverage_by_store",
    COVERAGE_SQL
    + """
SELECT official_store, CAST(sum(known) AS BIGINT) AS known, CAST(sum(found) AS BIGINT) AS found,
  round(100.0 - (CAST(sum(found) AS DOUBLE) / sum(known)) * 100.0, 2) AS percent_missing
FROM coverage GROUP BY 1
""",
)
def coverage_by_store(spark, d):
    """Roll-up of the coverage rows for the operations report."""
    summed = coverage(spark, d).groupBy("official_store").agg(
        F.sum("total_internal_order").alias("known"), F.sum("count_order_type").alias("found")
    )
    return summed.withColumn("percent_missing", gap_percent(F.col("found"), F.col("known")))
