import json

from pyspark.sql import functions as F

from bazaar.plans import shop_reports as S


def payloads(spark, *docs, **extra):
    df = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "payload string")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()}) if extra else df


def widget(key, *rows):
    cells = [{"columns": [{"value": v} for v in row]} for row in rows]
    return {"data": {"fetchSearchTableWidgetData": {"data": [{"dataKey": key, "data": {"rows": cells}}]}}}


def test_operational(spark):
    doc = [
        {"data": {}},
        widget("other", ["x"]),
        widget("communicationRate", ["Chat", "<b>98,5%</b>", "90%", "baik"], ["Diskusi", "", "80%", "-"]),
        widget("communicationSpeed", ["Chat", "12 menit", "60 menit", "cepat"], ["Diskusi", "2 jam", "1 hari", "-"]),
    ]
    now = F.lit("2024-03-05 18:00:00").cast("timestamp")
    row = S.operational_rows(payloads(spark, doc), now, official_store="toko").first()
    assert (row.chat_replied_rate, row.discussion_replied_rate) == (98.5, None)
    assert (row.chat_reply_speed, row.discussion_reply_speed) == (12, None)
    assert (row.chat_replied_rate_target, row.discussion_reply_speed_target) == ("90%", "1 hari")
    assert (str(row.start_date), str(row.end_date), row.official_store) == ("2024-02-28", "2024-03-05", "toko")
    assert S.operational_rows(payloads(spark, "[]"), now).first().chat_replied_rate is None


def test_shop_score(spark):
    def level(**more):
        return {"result": {"period": "1 Mei 2023 - 7 Agu 2023", "nextUpdate": "8 Des 2023", **more}}

    details = [
        {"identifier": n, "rawValue": v}
        for n, v in (("finish_rate", 0.5), ("penalty", 2.0), ("cnt_unique_buyer", 7.0), ("new_one", 1.0), ("x", 3.5))
    ]
    doc = {"data": {"shopScoreLevel": level(shopScore=88, shopScoreDetail=details), "shopLevel": level(shopLevel=3)}}
    row = S.score_rows(payloads(spark, doc), plain=["x"], official_store="toko").first()
    assert (row.finish_rate, row.penalty, row.count_unique_buyer, row.percent_good_rating) == (50.0, 2, 7, None)
    assert (row.shop_score, row.shop_level, row.x) == (88, 3, 3.5)
    assert (str(row.shop_score_start_date), str(row.shop_level_end_date), str(row.shop_level_next_update)) == (
        "2023-05-01", "2023-08-07", "2023-12-08",
    )


def test_official_stores(spark):
    html = (
        '<a href="/x">no</a><a class="c" data-testid="lblOSBrandLink" href="/toko-a"><img data-testid="imgOSBrBrandLogo" '
        'src="l.png"><p data-testid="lblOSBrBrandName">Toko &amp; A</p></a><a data-testid="lblOSBrandLink" href="/b"></a>'
    )
    rows = S.official_stores(spark.createDataFrame([(1, html)], "page_id int, html string"), ["page_id"]).collect()
    assert [tuple(r) for r in rows] == [(1, "/toko-a", "Toko & A", "l.png"), (1, "/b", None, None)]


def test_social(spark):
    def media(user, code):
        return {"layout_content": {"medias": [{"media": {"user": {"username": user}, "code": code}}]}}

    tags = {"data": {"top": {"sections": [media("u", "1"), {"layout_content": {}}]}, "recent": {"sections": [media("v", "2")]}}}
    rows = S.hashtag_posts(payloads(spark, tags, "{}", hashtag="h")).collect()
    assert {tuple(r) for r in rows} == {("h", "u", "1"), ("h", "v", "2")}

    def node(code, captions, tagged):
        return {"node": {
            "shortcode": code, "taken_at_timestamp": 1704067260, "owner": {"username": "u"},
            "edge_media_to_comment": {"count": 2}, "edge_liked_by": {"count": 3},
            "edge_media_to_caption": {"edges": [{"node": {"text": c}} for c in captions]},
            "edge_media_to_tagged_user": {"edges": [{"node": {"user": {"username": t}}} for t in tagged]},
        }}

    user = {"full_name": "U", "username": "u", "edge_followed_by": {"count": 5}, "edge_follow": {"count": 6},
            "biography": "WA 0812345678", "edge_owner_to_timeline_media": {"edges": [node("a", ["hi", "x"], ["v", "w"]), node("b", [], [])]}}
    docs = payloads(spark, {"graphql": {"user": user}})
    profile = S.profile_rows(docs).first()
    assert (profile.followers_count, profile.is_business_account, profile.external_url) == ("5", "false", "no links")
    first, second = S.post_rows(docs).orderBy("shortcode").collect()
    assert (first.post_caption, first.posted_at, first.post_n_likes, second.post_caption) == ("hi", "2024-01-01 00:01", 3, None)
    assert '"shortcode":"a"' in first.node_content
    assert {tuple(r) for r in S.tagged_users(docs).collect()} == {("u", "a", "v"), ("u", "a", "w")}
