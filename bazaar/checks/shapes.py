"""Whole feed shapes on payloads and pages built from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import check, day_text, table
from bazaar.functions import html as H
from bazaar.operators.contracts import contract
from bazaar.plans import payload_feeds as P
from bazaar.plans import shop_reports as S
from bazaar.plans.page_rules import category_rows


@check(
    "operational_report",
    r"""
SELECT conv_id, turn, CAST(turn + 0.5 AS DOUBLE) AS chat_replied_rate, 'a ' || t AS chat_replied_rate_target,
  'b ' || t AS chat_replied_rate_description, CAST(NULL AS DOUBLE) AS discussion_replied_rate, turn AS chat_reply_speed,
  'c ' || t AS discussion_reply_speed_description, '2024-01-24' AS start_date, '2024-01-30' AS end_date
FROM (SELECT conv_id, CAST(turn AS BIGINT) AS turn, replace(text, chr(10), ' ') AS t FROM conversations)
""",
)
def operational_report(spark, d):
    said = F.replace("text", F.lit("\n"), F.lit(" "))

    def row(*cells):
        return F.struct(F.array(*[F.struct(c.alias("value")) for c in cells]).alias("columns"))

    def widget(key, *rows):
        inner = F.struct(F.lit(key).alias("dataKey"), F.struct(F.array(*rows).alias("rows")).alias("data"))
        return F.struct(F.struct(F.struct(F.array(inner).alias("data")).alias("fetchSearchTableWidgetData")).alias("data"))

    turn, name = F.col("turn").cast("string"), F.lit("nama")
    w = [F.concat(F.lit(mark), said) for mark in ("a ", "b ", "c ")]
    doc = F.array(
        widget("communicationRate", row(name, F.concat(F.lit("<b>"), turn, F.lit(",5%</b>")), w[0], w[1]), row(name, name, name, name)),
        widget("communicationSpeed", row(name, F.concat(turn, F.lit(" menit")), name, name), row(name, name, name, w[2])),
    )
    talks = table(spark, d, "conversations").select("conv_id", "turn", F.to_json(doc).alias("payload"))
    rows = S.operational_rows(talks, F.lit("2024-01-31 03:00:00").cast("timestamp"))
    return rows.select(
        "conv_id", "turn", F.col("chat_replied_rate"), "chat_replied_rate_target", "chat_replied_rate_description",
        "discussion_replied_rate", "chat_reply_speed", "discussion_reply_speed_description",
        day_text(F.col("start_date")).alias("start_date"), day_text(F.col("end_date")).alias("end_date"),
    )


@check(
    "shop_score_report",
    """
SELECT o_orderkey, o_totalprice * 100 AS finish_rate, CAST(o_custkey AS BIGINT) AS penalty,
  CAST(o_custkey + 1 AS BIGINT) AS count_unique_buyer, CAST(NULL AS BIGINT) AS count_active_days,
  CAST(trunc(o_totalprice) AS BIGINT) AS shop_score, strftime(o_orderdate, '%Y-%m-%d') AS shop_level_start_date,
  strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS shop_level_end_date
FROM orders
""",
)
def shop_score_report(spark, d):
    from bazaar.functions.dates import id_date_text

    def metric(name, value):
        return F.struct(F.lit(name).alias("identifier"), value.cast("double").alias("rawValue"))

    period = F.concat_ws(" - ", id_date_text(F.col("o_orderdate")), id_date_text(F.date_add("o_orderdate", 30)))
    result = lambda *more: F.struct(F.struct(period.alias("period"), *more).alias("result"))
    details = F.array(
        metric("finish_rate", F.col("o_totalprice")), metric("unknown", F.lit(1)),
        metric("penalty", F.col("o_custkey")), metric("cnt_unique_buyer", F.col("o_custkey") + 1),
    )
    doc = F.struct(
        F.struct(
            result(F.col("o_totalprice").alias("shopScore"), details.alias("shopScoreDetail")).alias("shopScoreLevel"),
            result(F.lit(1.0).alias("shopLevel")).alias("shopLevel"),
        ).alias("data")
    )
    shops = table(spark, d, "orders").select("o_orderkey", F.to_json(doc).alias("payload"))
    return S.score_rows(shops).select(
        "o_orderkey", "finish_rate", "penalty", "count_unique_buyer", "count_active_days", "shop_score",
        day_text(F.col("shop_level_start_date")).alias("shop_level_start_date"),
        day_text(F.col("shop_level_end_date")).alias("shop_level_end_date"),
    )


@check(
    "hashtag_posts",
    """
SELECT lang AS hashtag, w AS username, CAST(doc_id AS VARCHAR) AS shortcode FROM (
  SELECT doc_id, lang, unnest(string_split(line, ' ')) AS w FROM (
    SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents))
UNION ALL SELECT lang, source, CAST(doc_id AS VARCHAR) FROM documents
""",
)
def hashtag_posts(spark, d):
    def section(users):
        medias = F.transform(
            users,
            lambda u: F.struct(
                F.struct(F.col("doc_id").cast("string").alias("code"), F.struct(u.alias("username")).alias("user")).alias("media")
            ),
        )
        return F.struct(F.struct(medias.alias("medias")).alias("layout_content"))

    top = F.transform(F.split("text", "\n"), lambda line: section(F.split(line, " ")))
    recent = F.array(section(F.array("source")))
    doc = F.struct(
        F.struct(F.struct(top.alias("sections")).alias("top"), F.struct(recent.alias("sections")).alias("recent")).alias("data")
    )
    docs = table(spark, d, "documents").select(F.col("lang").alias("hashtag"), F.to_json(doc).alias("payload"))
    return S.hashtag_posts(docs)


@check(
    "catalogue_payload",
    """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice * 100 / 100000) AS BIGINT) AS price,
  CAST(0 AS BIGINT) AS price_min, 'https://img.example.com/' || l_returnflag AS image, CAST(NULL AS BIGINT) AS bundle_deal_id,
  CAST(NULL AS VARCHAR) AS brand, 'toko' AS category_name
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, round(l_extendedprice * 100) / 100 AS l_extendedprice FROM lineitem)
""",
)
def catalogue_payload(spark, d):
    item = F.struct(
        F.col("l_orderkey"), F.col("l_linenumber"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"),
        F.lit(0).alias("price_min"), F.col("l_returnflag").alias("image"), F.lit("x").alias("extra"),
    )
    doc = F.to_json(F.struct(F.array(F.struct(item.alias("item_basic"))).alias("items")))
    rows = P.shape_payload(
        table(spark, d, "lineitem").select(doc.alias("payload")),
        P.PAYLOAD_FEEDS["catalogue_search"],
        "items array<struct<item_basic: struct<l_orderkey bigint, l_linenumber int, image string, price bigint, "
        "price_min bigint, brand string>>>",
        contract(
            [
                {"name": n, "type": t}
                for n, t in (("l_orderkey", "INTEGER"), ("l_linenumber", "INTEGER"), ("price", "INTEGER"),
                             ("price_min", "INTEGER"), ("image", "STRING"), ("brand", "STRING"), ("category_name", "STRING"))
            ]
            + [{"name": "bundle_deal_info", "type": "RECORD", "fields": [{"name": "bundle_deal_id", "type": "INTEGER"}]}]
        ),
        "https://img.example.com/",
        category_name="toko",
    )
    return rows.select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "price", "price_min", "image",
        F.col("bundle_deal_info.bundle_deal_id").alias("bundle_deal_id"), "brand", "category_name",
    )


@check(
    "category_page",
    r"""
SELECT page_id, i - 1 AS card, a[i] AS product_name, 1000 * i AS final_price,
  CASE WHEN i % 2 = 0 THEN 2000 * i ELSE 1000 * i END AS original_price, lang AS l2_category,
  'shop' AS store_id, 'p-' || CAST(i AS VARCHAR) AS product_id
FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a(?: [^>]*)?>([^<&]*)</a>', 1) AS a,
    nullif(regexp_extract(html, '(?i)<html [^>]*lang="([^"]*)"', 1), '') AS lang FROM pages),
  LATERAL (SELECT unnest(range(1, len(a) + 1)) AS i)
""",
)
def category_page(spark, d):
    """Pages whose links are laid out as item cards."""
    names = F.regexp_extract_all("html", F.lit("(?is)<a(?: [^>]*)?>([^<&]*)</a>"), F.lit(1))

    def card(name, i):
        shown = F.format_number((i + 1) * 1000, 0)
        sale = F.concat(F.lit('<div class="css-rn1hus">50%Rp'), F.format_number((i + 1) * 2000, 0), F.lit("</div>"))
        return F.concat(
            F.lit('<div class="css-bk6tzz e1nlzfl2"><a class="css-54k5sq" href="https://m.example.com/shop/p-'),
            (i + 1).cast("string"), F.lit('"><span class="css-20kt3o">'), name,
            F.lit('</span><span class="css-o5uqvq">Rp'), F.translate(shown, ",", "."), F.lit("</span>"),
            F.when(i % 2 == 1, F.translate(sale, ",", ".")).otherwise(F.lit("")), F.lit("</a></div>"),
        )

    head = F.concat(F.lit('<h1 class="css-1t4ww55">'), H.html_lang(F.col("html")), F.lit("</h1>"))
    pages = table(spark, d, "pages").select("page_id", F.concat(head, F.array_join(F.transform(names, card), "")).alias("html"))
    rows = category_rows(pages, ["page_id"])
    return rows.select(
        "page_id", F.col("card").cast("bigint").alias("card"), "product_name", "final_price", "original_price",
        "l2_category", "store_id", "product_id",
    )
