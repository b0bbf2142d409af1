"""Shop quality payloads, official store pages and social payloads to rows.

Each document is read within its own row: arrays are searched, not exploded and
grouped again, so none of these shapes shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions import dates as D
from bazaar.functions import html as H
from bazaar.functions import nested as J
from bazaar.functions import text as X
from bazaar.operators import contracts as C
from bazaar.sources.payloads import parse_payload

# Widget keys, metric identifiers and payload layouts.
RATE_WIDGET = "communicationRate"
SPEED_WIDGET = "communicationSpeed"
SCORE_PERCENT = ("finish_rate", "percent_good_rating", "chat_and_discussion_reply_rate")
SCORE_WHOLE = ("chat_and_discussion_reply_speed", "penalty")
SCORE_RENAMED = {"cnt_unique_buyer": "count_unique_buyer", "ct_active_days": "count_active_days"}

OPERATIONAL_SCHEMA = (
    "array<struct<data: struct<fetchSearchTableWidgetData: struct<data: array<struct<dataKey: string, "
    "data: struct<rows: array<struct<columns: array<struct<value: string>>>>>>>>>>>"
)
SCORE_SCHEMA = (
    "data struct<shopScoreLevel: struct<result: struct<shopScore: double, period: string, nextUpdate: string, "
    "shopScoreDetail: array<struct<identifier: string, rawValue: double>>>>, "
    "shopLevel: struct<result: struct<shopLevel: double, period: string, nextUpdate: string>>>"
)
_SECTIONS = (
    "struct<sections: array<struct<layout_content: struct<medias: array<struct<media: "
    "struct<code: string, user: struct<username: string>>>>>>>>"
)
HASHTAG_SCHEMA = f"data struct<top: {_SECTIONS}, recent: {_SECTIONS}>"
_EDGES = "struct<edges: array<struct<node: struct<{}>>>>"
SOCIAL_SCHEMA = (
    "graphql struct<user: struct<full_name: string, username: string, edge_followed_by: struct<count: bigint>, "
    "edge_follow: struct<count: bigint>, business_category_name: string, category_name: string, "
    "is_business_account: boolean, business_email: string, business_phone_number: string, biography: string, "
    "external_url: string, edge_owner_to_timeline_media: "
    + _EDGES.format(
        "shortcode: string, taken_at_timestamp: bigint, edge_media_to_comment: struct<count: bigint>, "
        "edge_liked_by: struct<count: bigint>, owner: struct<username: string>, edge_media_to_caption: "
        + _EDGES.format("text: string")
        + ", edge_media_to_tagged_user: "
        + _EDGES.format("user: struct<username: string>")
    )
    + ">>"
)


def _widget_rows(widgets: Column, key: str) -> Column:
    """Rows of all widgets with a key."""
    found = F.filter(widgets, lambda w: w.getField("dataKey") == key)
    return F.flatten(F.transform(found, lambda w: w.getField("data").getField("rows")))


def _cell(rows: str, row: int, col: int) -> Column:
    return H.strip_tags(F.get(F.get(F.col(rows), F.lit(row)).getField("columns"), F.lit(col)).getField("value"))


def operational_rows(payloads: DataFrame, now: Column, **tags: object) -> DataFrame:
    """Reply rates and speeds of a shop for the seven days before ``now``."""
    docs = parse_payload(payloads, "payload", OPERATIONAL_SCHEMA)
    widgets = F.flatten(
        F.filter(
            F.transform(
                "doc", lambda d: d.getField("data").getField("fetchSearchTableWidgetData").getField("data")
            ),
            lambda found: found.isNotNull(),
        )
    )
    listed = docs.drop("payload", "doc").columns
    held = docs.select(*listed, widgets.alias("widgets")).select(
        *listed,
        _widget_rows(F.col("widgets"), RATE_WIDGET).alias("rates"),
        _widget_rows(F.col("widgets"), SPEED_WIDGET).alias("speeds"),
    )
    out = []
    for row, subject in enumerate(("chat", "discussion")):
        rate, speed = f"{subject}_replied_rate", f"{subject}_reply_speed"
        out.append(X.parse_percent(_cell("rates", row, 1)).alias(rate))
        out.append(X.parse_minutes(_cell("speeds", row, 1)).alias(speed))
        for name, rows in ((rate, "rates"), (speed, "speeds")):
            out.append(_cell(rows, row, 2).alias(f"{name}_target"))
            out.append(_cell(rows, row, 3).alias(f"{name}_description"))
    start, end = D.report_period(D.business_day(now), "previous_7")
    return C.tag(held.select(*listed, *out), **tags, start_date=start, end_date=end)


def score_rows(payloads: DataFrame, plain: list[str] = (), **tags: object) -> DataFrame:
    """Shop score and level with one column per metric.

    ``plain`` names further identifiers taken as they are; unknown ones are ignored.
    """
    docs = parse_payload(payloads, "payload", SCORE_SCHEMA)
    score, level = F.col("doc.data.shopScoreLevel.result"), F.col("doc.data.shopLevel.result")

    def metric(identifier: str) -> Column:
        return J.find_element(score.getField("shopScoreDetail"), "identifier", identifier).getField("rawValue")

    columns = [
        *[metric(n).alias(n) for n in plain],
        *[(metric(n) * 100).alias(n) for n in SCORE_PERCENT],
        *[metric(n).cast("bigint").alias(n) for n in SCORE_WHOLE],
        *[metric(n).cast("bigint").alias(to) for n, to in SCORE_RENAMED.items()],
        score.getField("shopScore").cast("bigint").alias("shop_score"),
        level.getField("shopLevel").cast("bigint").alias("shop_level"),
    ]
    for name, part in (("shop_score", score), ("shop_level", level)):
        bounds = F.split(part.getField("period"), " - ")
        columns += [
            D.parse_id_date(F.try_element_at(bounds, F.lit(1))).alias(f"{name}_start_date"),
            D.parse_id_date(F.try_element_at(bounds, F.lit(2))).alias(f"{name}_end_date"),
            D.parse_id_date(part.getField("nextUpdate")).alias(f"{name}_next_update"),
        ]
    return C.tag(docs.select(*docs.drop("payload", "doc").columns, *columns), **tags)


def official_stores(pages: DataFrame, keep: list[str]) -> DataFrame:
    """(…, link, name, logo) of every official store anchor."""
    anchors = F.regexp_extract_all(
        F.col("html"), F.lit('(?is)<a [^>]*data-testid="lblOSBrandLink"[^>]*>.*?</a>'), F.lit(0)
    )
    rows = J.explode_rows(pages, anchors, keep, "a")
    label = F.regexp_extract("a", '(?is)<p [^>]*data-testid="lblOSBrBrandName"[^>]*>(.*?)</p>', 1)
    return rows.select(
        *keep,
        F.nullif(F.regexp_extract("a", '(?is)^<a [^>]*href="([^"]*)"', 1), F.lit("")).alias("link"),
        F.nullif(H.strip_tags(label), F.lit("")).alias("name"),
        H.image_attribute(F.col("a"), 'data-testid="imgOSBrBrandLogo"', "src").alias("logo"),
    )


def hashtag_posts(payloads: DataFrame, hashtag: str = "hashtag") -> DataFrame:
    """(hashtag, username, shortcode) of all top and recent posts."""
    docs = parse_payload(payloads, "payload", HASHTAG_SCHEMA)
    empty = F.array().cast("array<struct<layout_content: struct<medias: array<struct<media: struct<code: string, user: struct<username: string>>>>>>>")
    sections = F.concat(*[F.coalesce(F.col(f"doc.data.{part}.sections"), empty) for part in ("top", "recent")])
    medias = F.flatten(F.transform(sections, lambda s: F.coalesce(s.getField("layout_content").getField("medias"), F.array())))
    return J.explode_rows(docs, medias, [hashtag], "m").select(
        hashtag, F.col("m.media.user.username").alias("username"), F.col("m.media.code").alias("shortcode")
    )


def profile_rows(payloads: DataFrame) -> DataFrame:
    """Social profiles as text columns; missing keys get their defaults."""
    user = F.col("doc.graphql.user")
    fields = {
        "name": user.getField("full_name"),
        "username": user.getField("username"),
        "followers_count": user.getField("edge_followed_by").getField("count"),
        "following_count": user.getField("edge_follow").getField("count"),
        "business_category": user.getField("business_category_name"),
        "category": user.getField("category_name"),
        "is_business_account": F.coalesce(user.getField("is_business_account"), F.lit(False)),
        "business_email": user.getField("business_email"),
        "business_phone_number": user.getField("business_phone_number"),
        "biography": user.getField("biography"),
        "external_url": F.coalesce(user.getField("external_url"), F.lit("no links")),
    }
    docs = parse_payload(payloads, "payload", SOCIAL_SCHEMA)
    return docs.select(*[c.cast("string").alias(n) for n, c in fields.items()])


def _posts(payloads: DataFrame) -> DataFrame:
    docs = parse_payload(payloads, "payload", SOCIAL_SCHEMA)
    edges = F.col("doc.graphql.user.edge_owner_to_timeline_media.edges")
    return J.explode_rows(docs, edges, [], "edge").select("edge", "edge.node.*")


def post_rows(payloads: DataFrame) -> DataFrame:
    """Posts of the profiles, captions from their first caption edge."""
    first = F.get(F.col("edge_media_to_caption.edges"), F.lit(0)).getField("node").getField("text")
    return _posts(payloads).select(
        F.to_json("edge").alias("node_content"),
        F.col("owner.username").alias("owner_username"),
        "shortcode",
        D.epoch_to_text(F.col("taken_at_timestamp")).alias("posted_at"),
        first.alias("post_caption"),
        F.col("edge_media_to_comment.count").alias("post_n_comments"),
        F.col("edge_liked_by.count").alias("post_n_likes"),
    )


def tagged_users(payloads: DataFrame) -> DataFrame:
    """(owner, post, tagged): one row per user tagged in a post."""
    names = F.transform("edge_media_to_tagged_user.edges", lambda e: e.getField("node").getField("user").getField("username"))
    posts = _posts(payloads).select(F.col("owner.username").alias("o"), F.col("shortcode").alias("s"), names.alias("n"))
    return J.edge_list(posts, "o", "s", F.col("n"))
