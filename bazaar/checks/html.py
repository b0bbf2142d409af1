"""Extraction from stored pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import check, table
from bazaar.functions import html as H
from bazaar.functions.nested import explode_rows

RULES = [
    H.Rule("title", "title", nth=0),
    H.Rule("heading", "h1"),
    H.Rule("link", "a", take="href"),
    H.Rule("ad", "div", "class", "ad"),
    H.Rule("charset", "meta", "charset", take="charset", nth=0),
    H.Rule("item", "li"),
]


def _decoded(sql: str) -> str:
    """The references that occur in the pages; the ampersand comes last."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        sql = f"regexp_replace({sql}, '&{name};?', '{char}', 'g')"
    return sql


def _bare(sql: str) -> str:
    return f"regexp_replace({sql}, '<[^>]*>', '', 'g')"


# Scripts and comments hold no elements; the parser never sees tags in them.
_VISIBLE = r"regexp_replace(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>', '', 'g')"
_FOUND = {
    "title": (r"(?is)<title>(.*?)</title>", "{}[1:1]"),
    "heading": (r"(?is)<h1(?: [^>]*)?>(.*?)</h1>", "{}"),
    "link": (r'(?is)<a [^>]*href="([^"]*)"', "{}"),
    "ad": (r'(?is)<div class="ad">(.*?)</div>', "{}"),
    "charset": (r'(?is)<meta charset="([^"]*)"', "{}[1:1]"),
    "item": (r"(?is)<li(?: [^>]*)?>(.*?)</li>", "{}"),
}
_ELEMENTS = " UNION ALL ".join(
    f"SELECT page_id, '{name}' AS field, {keep.format(f'regexp_extract_all({_VISIBLE}, $${pattern}$$, 1)')} AS hits FROM pages"
    for name, (pattern, keep) in _FOUND.items()
)


@check(
    "html_elements",
    f"""
SELECT page_id, field, CAST(i - 1 AS INTEGER) AS ordinal, {_decoded(_bare("hits[i]"))} AS value
FROM ({_ELEMENTS}), LATERAL (SELECT unnest(range(1, len(hits) + 1)) AS i)
""",
)
def html_elements(spark, d):
    return H.extract_elements(table(spark, d, "pages"), RULES)


@check(
    "html_links",
    r"""
SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a [^>]*href="([^"]*)"', 1)) AS href FROM pages
""",
)
def html_links(spark, d):
    return explode_rows(table(spark, d, "pages"), H.links(F.col("html")), ["page_id"], "href")


@check(
    "html_links_marked",
    r"""
SELECT page_id, unnest(list_transform(list_filter(regexp_extract_all(html, '(?i)<a [^>]*>'),
  lambda a: strpos(a, 'href="/the"') > 0), lambda a: regexp_extract(a, 'href="([^"]*)"', 1))) AS href FROM pages
""",
)
def html_links_marked(spark, d):
    marked = H.links_with(F.col("html"), "href", "/the")
    return explode_rows(table(spark, d, "pages"), marked, ["page_id"], "href")


STRIP_SQL = r"""regexp_replace(regexp_replace(html,
  '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g'), '<[^>]*>', '', 'g')"""


@check("html_strip_tags", f"SELECT page_id, {_decoded(STRIP_SQL)} AS text FROM pages")
def html_strip_tags(spark, d):
    return table(spark, d, "pages").select("page_id", H.strip_tags(F.col("html")).alias("text"))


@check(
    "html_blocks",
    f"""
SELECT page_id, i - 1 AS ordinal, title, {_decoded(_bare("blocks[i]"))} AS text FROM (
  SELECT page_id, nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') AS title,
    regexp_extract_all(html, '(?is)<p(?: [^>]*)?>(.*?)</p>', 1) AS blocks FROM pages),
  LATERAL (SELECT unnest(range(1, len(blocks) + 1)) AS i)
""",
)
def html_blocks(spark, d):
    from bazaar.plans.catalogue import cards

    pages = table(spark, d, "pages").select("page_id", H.title(F.col("html")).alias("title"), "html")
    rows = cards(pages, ["page_id", "title"], H.tag_bodies(F.col("html"), "p"), {"text": H.strip_tags(F.col("block"))})
    return rows.select("page_id", F.col("card").cast("bigint").alias("ordinal"), "title", "text")


SHOP_METRICS = ["jumlah_penilaian", "persen_dibalas", "waktu_dibalas", "bergabung", "pengikut"]


@check(
    "list_to_columns",
    "SELECT page_id, "
    + ", ".join(f"items[{i + 1}] AS {n}" for i, n in enumerate(SHOP_METRICS))
    + r" FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li(?: [^>]*)?>(.*?)</li>', 1) AS items FROM pages)",
)
def list_to_columns(spark, d):
    items = table(spark, d, "pages").select("page_id", H.tag_bodies(F.col("html"), "li").alias("items"))
    return items.select("page_id", *H.list_to_columns(F.col("items"), SHOP_METRICS))


@check(
    "html_meta",
    r"""
SELECT page_id, nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') AS title,
  nullif(regexp_extract(html, '(?i)<html [^>]*lang="([^"]*)"', 1), '') AS lang,
  url AS desktop_url, '/img/' || CAST(page_id AS VARCHAR) AS image, CAST(NULL AS VARCHAR) AS absent
FROM pages
""",
)
def html_meta(spark, d):
    extra = F.concat(
        F.lit('<meta content="x" name="other"><meta content="'), "url", F.lit('" name="desktop_url">'),
        F.lit('<img src="/img/'), F.col("page_id").cast("string"), F.lit('" data-testid="main">'),
    )
    html = F.concat("html", extra)
    return table(spark, d, "pages").select(
        "page_id",
        H.title(html).alias("title"),
        H.html_lang(html).alias("lang"),
        H.meta_content(html, "desktop_url").alias("desktop_url"),
        H.image_attribute(html, 'data-testid="main"', "src").alias("image"),
        H.meta_content(html, "absent").alias("absent"),
    )
