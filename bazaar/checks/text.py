"""Text functions on texts derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import check, table
from bazaar.functions import html as H
from bazaar.functions import numbers as N
from bazaar.functions import text as X

# Report style money text of an amount: thousands dots and a decimal comma.
MONEY_SQL = (
    "replace(replace(replace(format('{:,.2f}', o_totalprice), ',', ';'), '.', ','), ';', '.')"
)


def money_text(amount):
    grouped = F.format_number(amount, 2)
    return F.translate(grouped, ",.", ".,")


@check(
    "parse_money",
    """
SELECT o_orderkey,
  round(o_totalprice, 2) AS rupiah, round(o_totalprice, 2) AS coded, CAST(NULL AS DOUBLE) AS broken
FROM orders
""",
)
def parse_money(spark, d):
    shown = money_text(F.col("o_totalprice"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        X.parse_money(F.concat(F.lit("Rp"), shown)).alias("rupiah"),
        X.parse_money(F.concat(F.lit("IDR "), shown)).alias("coded"),
        X.parse_money(F.concat(F.lit("gratis "), shown)).alias("broken"),
    )


@check(
    "digits_only",
    """
SELECT p_partkey, CAST(nullif(regexp_replace(p_brand || '-' || CAST(p_size AS VARCHAR), '[^0-9]', '', 'g'), '') AS BIGINT)
  AS digits, TRY_CAST(nullif(regexp_replace(p_name, '[^0-9]', '', 'g'), '') AS BIGINT) AS none
FROM part
""",
)
def digits_only(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        X.digits_only(F.concat_ws("-", "p_brand", F.col("p_size").cast("string"))).alias("digits"),
        X.digits_only(F.col("p_name")).alias("none"),
    )


@check(
    "parse_abbrev_count",
    """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS plain, CAST(l_quantity * 1000 AS BIGINT) AS thousands,
  CAST(l_quantity * 1000 + 100 * l_linenumber AS BIGINT) AS fraction
FROM lineitem
""",
)
def parse_abbrev_count(spark, d):
    whole = F.col("l_quantity").cast("int").cast("string")
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        X.parse_abbrev_count(F.concat(F.lit("Terjual "), whole)).alias("plain"),
        X.parse_abbrev_count(F.concat(F.lit("Terjual "), whole, F.lit(" rb+"))).alias("thousands"),
        X.parse_abbrev_count(F.concat(whole, F.lit(","), F.col("l_linenumber").cast("string"), F.lit(" rb"))).alias(
            "fraction"
        ),
    )


@check(
    "parse_percent",
    """
SELECT l_orderkey, l_linenumber, l_discount AS with_comma, l_tax AS with_dot, CAST(NULL AS DOUBLE) AS dashes
FROM lineitem
""",
)
def parse_percent(spark, d):
    discount = F.translate(F.col("l_discount").cast("string"), ".", ",")
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        X.parse_percent(F.concat(discount, F.lit("%"))).alias("with_comma"),
        X.parse_percent(F.concat(F.col("l_tax").cast("string"), F.lit("%"))).alias("with_dot"),
        X.parse_percent(F.lit("--")).alias("dashes"),
    )


@check(
    "parse_minutes",
    """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS BIGINT) END AS minutes FROM part
""",
)
def parse_minutes(spark, d):
    unit = F.when(F.col("p_size") % 2 == 0, " menit").otherwise(" jam")
    return table(spark, d, "part").select(
        "p_partkey", X.parse_minutes(F.concat(F.col("p_size").cast("string"), unit)).alias("minutes")
    )


@check(
    "strip_tabs",
    "SELECT c_custkey, c_name AS name, CAST(NULL AS VARCHAR) AS only_tabs FROM customer",
)
def strip_tabs(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        X.strip_tabs(F.concat("c_name", F.lit("\t"))).alias("name"),
        X.strip_tabs(F.repeat(F.lit("\t"), F.col("c_nationkey") % 3)).alias("only_tabs"),
    )


@check(
    "clean_multiline",
    r"""
SELECT doc_id, replace(text, chr(10), ' ') AS one_line,
  regexp_replace(text, '\n[A-Za-z]*[\t\n\f\r\x0B ][A-Za-z]*', ' ', 'g') AS name_line
FROM documents
""",
)
def clean_multiline(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        X.one_line(F.col("text")).alias("one_line"),
        X.drop_second_line_words(F.col("text")).alias("name_line"),
    )


@check(
    "int_from_float_text",
    """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity,
  CASE WHEN l_extendedprice = floor(l_extendedprice) THEN CAST(l_extendedprice AS BIGINT) END AS price
FROM lineitem
""",
)
def int_from_float_text(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        X.int_from_float_text(F.col("l_quantity").cast("string")).alias("quantity"),
        X.int_from_float_text(F.col("l_extendedprice").cast("string")).alias("price"),
    )


@check("slug", "SELECT c_custkey, lower(regexp_replace(c_name, '[^A-Za-z]', '_', 'g')) AS slug FROM customer")
def slug(spark, d):
    return table(spark, d, "customer").select("c_custkey", X.slug(F.col("c_name")).alias("slug"))


@check(
    "title_clean",
    """
SELECT p_partkey, array_to_string(list_transform(string_split(
    trim(regexp_replace(replace(p_name || '-' || lower(p_type) || CAST(p_size AS VARCHAR), '-', ' '), '[0-9]', '', 'g')), ' '),
    lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS title
FROM part
""",
)
def title_clean(spark, d):
    raw = F.concat("p_name", F.lit("-"), F.lower("p_type"), F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", X.title_clean(raw).alias("title"))


@check(
    "url_clean",
    """
SELECT page_id, regexp_replace(url, '.*r=', '') AS tail, url AS decoded,
  regexp_replace(url, '[?].*', '') AS cut
FROM pages
""",
)
def url_clean(spark, d):
    wrapped = lambda c: F.concat(F.lit("https://ad.example.com/c?x=1&r="), c)
    escaped = F.replace(F.url_encode("url"), F.lit("%3F"), F.lit("%253F"))
    cut = F.url_encode("url")
    return table(spark, d, "pages").select(
        "page_id",
        X.url_clean(F.col("url")).alias("tail"),
        F.replace(X.url_clean(wrapped(escaped)), F.lit("%3F"), F.lit("?")).alias("decoded"),
        X.url_clean(wrapped(cut)).alias("cut"),
    )


@check(
    "url_ids",
    """
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
  string_split(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*', ''), '[?#].*$', ''), '/')[2] AS first_segment,
  string_split(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*', ''), '[?#].*$', ''), '/')[3] AS second_segment,
  string_split(url, '.')[-2] AS shop_id, string_split(url, '.')[-1] AS product_id
FROM pages
""",
)
def url_ids(spark, d):
    path = X.url_path(F.col("url"))
    shop, product = X.dotted_ids(F.col("url"))
    return table(spark, d, "pages").select(
        "page_id",
        X.url_host(F.col("url")).alias("host"),
        X.segment(path, 1).alias("first_segment"),
        X.segment(path, 2).alias("second_segment"),
        shop.alias("shop_id"),
        product.alias("product_id"),
    )


@check(
    "url_prefix",
    """
SELECT p_partkey, 'https://img.example.com/file/' || CASE WHEN p_size > 25 THEN p_brand END AS image,
  'https://shop.example.com/' || p_name AS brand_url FROM part
""",
)
def url_prefix(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        X.url_prefix("https://img.example.com/file/", F.when(F.col("p_size") > 25, F.col("p_brand"))).alias("image"),
        X.url_prefix("https://shop.example.com/", F.col("p_name")).alias("brand_url"),
    )


@check(
    "path_segment",
    """
SELECT page_id, string_split(url, '/')[-1] AS last, string_split(url, '/')[-2] AS before_last,
  nullif(regexp_extract(url, '^[^/]*/[^/]*/[^/]*/[^/]*/(.*)$', 1), '') AS rest, string_split(url, '_')[1] AS head
FROM pages
""",
)
def path_segment(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id",
        X.segment(url, -1).alias("last"),
        X.segment(url, -2).alias("before_last"),
        X.rest_after(url, 4).alias("rest"),
        X.segment(url, 0, "_").alias("head"),
    )


@check(
    "extract_phones",
    """
WITH runs AS (
  SELECT doc_id, list_filter(
      regexp_extract_all(regexp_replace(text || ' WA 0812-3456.' || CAST(doc_id AS VARCHAR), '[-. ]', '', 'g'), '[0-9]+'),
      lambda x: (x LIKE '08%' OR x LIKE '628%') AND length(x) >= 7) AS found
  FROM documents
)
SELECT doc_id, CASE WHEN len(found) > 0 THEN array_to_string(found, ',') END AS phones FROM runs
""",
)
def extract_phones(spark, d):
    contact = F.concat("text", F.lit(" WA 0812-3456."), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select("doc_id", X.extract_phones(contact).alias("phones"))


@check(
    "phone_from_link",
    """
WITH links AS (
  SELECT page_id, 'https://wa.example.com/' || CAST(62800000000 + page_id * 37 AS VARCHAR) || '?text=' || url AS link,
    url FROM pages
)
SELECT page_id,
  array_to_string(regexp_extract_all(substr(link, strpos(link, '628'), 20), '[0-9]+'), ',') AS chat,
  CASE WHEN strpos(url, '628') > 0 THEN
    array_to_string(regexp_extract_all(substr(url, strpos(url, '628'), 20), '[0-9]+'), ',') END AS page
FROM links
""",
)
def phone_from_link(spark, d):
    number = (F.lit(62800000000) + F.col("page_id") * 37).cast("string")
    link = F.concat(F.lit("https://wa.example.com/"), number, F.lit("?text="), "url")
    return table(spark, d, "pages").select(
        "page_id", X.phone_from_link(link).alias("chat"), X.phone_from_link(F.col("url")).alias("page")
    )


@check(
    "pack_unpack",
    """
SELECT p_partkey, p_brand || ' | ' || p_name || ' | ' || p_type AS packed, p_brand AS brand, p_name AS name,
  CAST(NULL AS VARCHAR) AS beyond, p_type || '_' || CAST(p_size AS VARCHAR) AS pair, p_type AS pair_head
FROM part
""",
)
def pack_unpack(spark, d):
    packed = X.pack("p_brand", "p_name", "p_type")
    pair = X.pack(F.col("p_type"), F.col("p_size").cast("string"), sep="_")
    return table(spark, d, "part").select(
        "p_partkey",
        packed.alias("packed"),
        X.unpack(packed, 0).alias("brand"),
        X.unpack(packed, 1).alias("name"),
        X.unpack(packed, 3).alias("beyond"),
        pair.alias("pair"),
        X.unpack(pair, 0, "_").alias("pair_head"),
    )


@check(
    "spec_join",
    r"""
WITH specs AS (
  SELECT page_id, list_append(regexp_extract_all(html, '(?is)<a(?: [^>]*)?>(.*?)</a>', 1),
    'Dikirim Dari ' || regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS spec FROM pages
)
SELECT page_id, array_to_string(spec, ' | ') AS spesifikasi, string_split(spec[-1], 'Dari')[2] AS dikirim_dari
FROM specs
""",
)
def spec_join(spark, d):
    origin = F.concat(F.lit("Dikirim Dari "), X.url_host(F.col("url")))
    specs = F.array_append(H.tag_bodies(F.col("html"), "a"), origin)
    return table(spark, d, "pages").select(
        "page_id", X.spec_text(specs).alias("spesifikasi"), X.spec_origin(specs).alias("dikirim_dari")
    )


@check(
    "case_seller_type",
    """
SELECT s_suppkey, CASE WHEN s_nationkey % 3 = 0 THEN 'Star' WHEN s_acctbal > 5000 THEN 'Mall'
  ELSE 'not Star or Mall' END AS seller_type
FROM supplier
""",
)
def case_seller_type(spark, d):
    badge = F.when(F.col("s_nationkey") % 3 == 0, "Star").otherwise("")
    mark = F.when(F.col("s_acctbal") > 5000, "mark")
    return table(spark, d, "supplier").select("s_suppkey", X.seller_type(badge, mark).alias("seller_type"))


@check(
    "scale_price",
    """
SELECT l_orderkey, l_linenumber, CAST(trunc(raw / 100000) AS BIGINT) AS always,
  CASE WHEN raw > 0 THEN CAST(trunc(raw / 100000) AS BIGINT) ELSE raw END AS positive_only
FROM (SELECT l_orderkey, l_linenumber,
  CAST(round((l_extendedprice - 50000) * 1000) AS BIGINT) AS raw FROM lineitem)
""",
)
def scale_price(spark, d):
    raw = F.round((F.col("l_extendedprice") - 50000) * 1000).cast("bigint")
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        N.scale_price(raw).alias("always"),
        N.scale_price(raw, positive_only=True).alias("positive_only"),
    )


@check(
    "price_fallback",
    """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN l_extendedprice ELSE l_discount END AS price FROM lineitem
""",
)
def price_fallback(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", N.price_fallback(F.col("l_discount"), F.col("l_extendedprice")).alias("price")
    )


@check(
    "derived_measures",
    """
SELECT l_orderkey, l_linenumber,
  l_quantity + CASE WHEN l_returnflag <> 'R' THEN l_linenumber END + 1 AS total,
  l_extendedprice - l_quantity - l_linenumber AS remainder
FROM lineitem
""",
)
def derived_measures(spark, d):
    some = F.when(F.col("l_returnflag") != "R", F.col("l_linenumber"))
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        N.total(F.col("l_quantity"), some, F.lit(1)).alias("total"),
        N.remainder(F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_linenumber")).alias("remainder"),
    )
