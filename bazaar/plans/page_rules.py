"""Extraction rules of catalogue pages.

Fixed values: the class names and data attributes of the marketplace pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions import html as H
from bazaar.functions import numbers as N
from bazaar.functions import text as X
from bazaar.functions.nested import explode_rows

PAGE_RULES = [
    H.Rule("l1_category", "a", "class", "css-wms9d7", nth=2),
    H.Rule("l2_category", "h1", "class", "css-1t4ww55", nth=0),
    H.Rule("l3_category", "a", "class", "css-wms9d7", nth=3),
]

CARD_RULES = [
    H.Rule("product_name", "span", "class", "css-20kt3o", nth=0),
    H.Rule("final_price", "span", "class", "css-o5uqvq", nth=0),
    H.Rule("location", "span", "class", "css-ywdpwd", nth=0),
    H.Rule("store_name", "span", "class", "css-ywdpwd", nth=1),
    H.Rule("product_url", "a", "class", "css-54k5sq", take="href", nth=0),
    H.Rule("original_price", "div", "class", "css-rn1hus", nth=0),
    H.Rule("sold", "div", "class", "css-1riykrk", nth=0),
    H.Rule("store_type", "img", take="src", nth=0, within=("div", "class", "css-1hy7m5k")),
]
CARD_BLOCK = '<div class="css-bk6tzz e1nlzfl2"[^>]*>'

ITEM_RULES = [
    H.Rule("url", "meta", "name", "branch:deeplink:$desktop_url", take="content", nth=0),
    H.Rule("product_id", "meta", "name", "branch:deeplink:$ios_deeplink_path", take="content", nth=0),
    H.Rule("store_id", "img", "class", "css-1nf4dbc", take="src", nth=0),
    H.Rule("sold", "div", "data-testid", "lblPDPDetailProductSoldCounter", nth=0),
    H.Rule("stock", "p", "class", "css-1hhh2ha-unf-heading e1qvo2ff8", nth=0),
    H.Rule("seller_type", "img", "class", "css-ebxddb", take="alt", nth=0),
    H.Rule("item_rating", "span", "data-testid", "lblPDPDetailProductRatingNumber", nth=0),
    H.Rule("rating_count", "span", "data-testid", "lblPDPDetailProductRatingCounter", nth=0),
    H.Rule("discussion_count", "div", "data-testid", "lblPDPDetailProductDiscussionNumber", nth=0),
    H.Rule("response_time", "div", "data-testid", "lblPDPShopPackSecond", nth=0),
    H.Rule("item_image", "img", "data-testid", "PDPMainImage", take="src", nth=0),
    H.Rule("item_desc", "div", "data-testid", "lblPDPDescriptionProduk", nth=0),
]

# Fixed value: position of the shop folder in an image address.
STORE_SEGMENT = 10


def category_rows(pages: DataFrame, keep: list[str]) -> DataFrame:
    """One row per item card, with the page's categories repeated."""
    head = H.extract_fields(pages, PAGE_RULES, [*keep, "html"])
    blocks = F.slice(F.split("html", CARD_BLOCK), F.lit(2), F.lit(1 << 30))
    named = [r.field for r in PAGE_RULES]
    cards = explode_rows(head, blocks, [*keep, *named], "block", "card")
    rows = H.extract_fields(cards, CARD_RULES, [*keep, *named, "card"], html="block")
    url = X.url_clean(F.col("product_url"))
    after_price_word = F.regexp_replace("original_price", ".*Rp", "")
    final = X.digits_only(F.col("final_price"))
    shown = {
        "product_url": url,
        "store_id": X.segment(X.url_path(url), 1),
        "product_id": X.segment(X.url_path(url), 2),
        "final_price": final,
        "original_price": N.price_fallback(F.coalesce(X.digits_only(after_price_word), F.lit(0)), final),
        "sold": X.digits_only(F.col("sold")),
    }
    return rows.withColumns(shown)


def item_rows(pages: DataFrame, keep: list[str]) -> DataFrame:
    """One row per item page."""
    raw = H.extract_fields(pages, ITEM_RULES, keep)

    def whole(name: str) -> Column:
        return X.digits_only(F.col(name))

    return raw.withColumns(
        {
            "product_id": X.segment(F.col("product_id"), -1),
            "store_id": X.segment(X.url_clean(F.col("store_id")), STORE_SEGMENT),
            "sold": X.parse_abbrev_count(F.col("sold")),
            "seller_type": X.url_clean(F.col("seller_type")),
            "stock": whole("stock"),
            "item_rating": X.to_number(F.col("item_rating")),
            "rating_count": whole("rating_count"),
            "discussion_count": whole("discussion_count"),
            "response_time": whole("response_time"),
            "item_image": X.url_clean(F.col("item_image")),
        }
    )
