import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazaar.functions import dates as D
from bazaar.functions import html as H
from bazaar.functions import nested as J
from bazaar.functions import numbers as N
from bazaar.functions import text as X
from tests.conftest import column


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


CASES = [
    (X.parse_money, {"Rp1.234.567": 1234567.0, "IDR 12.345,5": 12345.5, "1000.0": 1000.0, "1000": 1000.0,
                     "rp 5": 5.0, "gratis": None, "": None, None: None, "-1.000": -1000.0}),
    (X.digits_only, {"Terjual 1.2k": 12, "abc": None, "": None, None: None, "007": 7, "9" * 25: None}),
    (X.parse_abbrev_count, {"1,2 rb": 1200, "3 rb+": 3000, "250": 250, "Terjual 1.234": 1234, "baru": None,
                            "1.200 rb": 1200000, None: None}),
    (X.parse_percent, {"98,5%": 98.5, "1.2%": 1.2, "--": None, None: None, "0%": 0.0}),
    (X.parse_minutes, {"12 menit": 12, "2 jam": None, "": None, "menit": None}),
    (X.strip_tabs, {"12345\t": "12345", "\t": None, "": None, "a\tb": "ab"}),
    (X.one_line, {"a\nb": "a b", "a": "a"}),
    (X.drop_second_line_words, {"Budi\nPembeli Baru": "Budi ", "Budi": "Budi", "A\nB": "A\nB"}),
    (X.int_from_float_text, {"12.0": 12, "12": 12, "1.5": None, "10.05": None, "x": None, "": None}),
    (X.slug, {"Toko ABC 12": "toko_abc___"}),
    (X.title_clean, {"fashion-wanita-1": "Fashion Wanita", "HP": "Hp"}),
    (X.url_clean, {"https://ad/x?r=https%3A%2F%2Fa.b%2Fc%3Fq%3D1": "https://a.b/c", "https://a.b/c+d": "https://a.b/c+d",
                   "r=%ZZ": "%ZZ", None: None}),
    (X.url_path, {"https://a.b/c/d?x=1#y": "/c/d", "http://a.b": ""}),
    (X.url_host, {"https://a.b/c": "a.b", "nothing": ""}),
    (X.extract_phones, {"WA 0812-3456.789 ya": "0812" + "3456789", "telp 628 12 34 56 7": "6281234567", "021 12": None,
                        "08123": None, "": None, None: None, "0811111, 6282222222": "0811111,6282222222"}),
    (X.phone_from_link, {"https://wa/6281234567890?text=12": "6281234567890,1", "none": None, None: None}),
    (X.to_number, {"1e3": 1000.0, " 2 ": 2.0, "1d": None, "NaN": None, ".5": 0.5, "5.": 5.0, "-": None}),
    (lambda c: X.segment(c, -1), {"a/b/c": "c", "": "", None: None}),
    (lambda c: X.segment(c, 4), {"a/b/c/d/e/f": "e", "a": None}),
    (lambda c: X.rest_after(c, 4), {"a/b/c/d/e/f": "e/f", "a/b": None}),
    (lambda c: X.unpack(c, 1), {"a | b | c": "b", "a": None}),
    (lambda c: D.parse_id_date(c).cast("string"), {"7 Agu 2023": "2023-08-07", "17-Agustus-2023": "2023-08-17",
                                                    "1 Mei 2023": "2023-05-01", "31 Feb 2023": None, "1 Foo 2023": None}),
    (lambda c: D.parse_dates(c, D.REPORT_FORMATS["day_first_seconds"], D.REPORT_FORMATS["iso_day"]).cast("string"),
     {"31/12/2023 10:11:12": "2023-12-31 10:11:12", "1/2/2023 1:02:03": "2023-02-01 01:02:03",
      "2023-02-01": "2023-02-01 00:00:00", "32/12/2023 10:11:12": None, "": None}),
    (H.decode_entities, {"a &lt; b &#39;&#8364;&nbsp;x": "a < b '\u20ac\u00a0x", "R&D &foo; &": "R&D &foo; &", "&copy 1": "\u00a9 1",
                         "plain": "plain", "": "", None: None, "&amp;lt;": "&lt;"}),
    (H.strip_tags, {"<b>a</b> &amp;lt; <script>x</script>b<!-- c -->": "a &lt; b"}),
]


@pytest.mark.parametrize("function,pairs", CASES)
def test_text_cases(spark, function, pairs):
    df = texts(spark, list(pairs))
    assert column(df, function(F.col("t"))) == list(pairs.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="08126-. ab\n", max_size=40), min_size=1, max_size=20))
def test_phones_match_a_plain_reading(spark, values):
    def plain(value):
        runs = re.findall("[0-9]+", re.sub("[-. ]", "", value))
        return ",".join(r for r in runs if r.startswith(("08", "628")) and len(r) >= 7) or None

    assert column(texts(spark, values), X.extract_phones(F.col("t"))) == [plain(v) for v in values]


def test_hashed_phones_hide_the_number(spark):
    df = texts(spark, ["0812345678", "none"])
    hashed = column(df, X.extract_phones(F.col("t"), hashed=True))
    assert len(hashed[0]) == 64 and hashed[1] is None


def test_seller_type(spark):
    df = spark.createDataFrame([("Star", None), ("", "x"), (None, None), ("", "")], "b string, m string")
    assert column(df, X.seller_type(F.col("b"), F.col("m"))) == [
        "Star", "Mall", "not Star or Mall", "not Star or Mall",
    ]


def test_prices(spark):
    df = spark.createDataFrame([(1234567,), (0,), (-250000,), (None,)], "p bigint")
    assert column(df, N.scale_price(F.col("p"))) == [12, 0, -2, None]
    assert column(df, N.scale_price(F.col("p"), positive_only=True)) == [12, 0, -250000, None]


def test_gap_percent(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (3, 3), (None, 1)], "a int, b int")
    assert column(df, N.gap_percent(F.col("a"), F.col("b"))) == [66.67, None, 0.0, None]


@pytest.mark.parametrize(
    "kind,start,end",
    [
        ("today", "2024-03-06", "2024-03-06"),
        ("last_7", "2024-02-29", "2024-03-06"),
        ("last_30", "2024-02-06", "2024-03-06"),
        ("current_week", "2024-03-04", "2024-03-06"),
        ("current_month", "2024-03-01", "2024-03-31"),
        ("month_to_date", "2024-03-01", "2024-03-06"),
        ("previous_7", "2024-02-28", "2024-03-05"),
    ],
)
def test_report_periods(spark, kind, start, end):
    today = F.lit("2024-03-06").cast("date")
    a, b = D.report_period(today, kind)
    row = spark.range(1).select(a.cast("string"), b.cast("string")).first()
    assert tuple(row) == (start, end)


def test_business_day_turns_at_local_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 16, 59),), (dt.datetime(2024, 1, 1, 17, 0),)], "t timestamp")
    days = column(df.withColumn("t", F.to_timestamp(F.date_format("t", "yyyy-MM-dd HH:mm"))), D.business_day(F.col("t")))
    assert (days[1] - days[0]).days == 1


def test_period_rules(spark):
    rows = [("2024-01-20", "2024-02-03"), ("2024-01-01", "2024-01-31"), ("2023-12-20", "2024-01-03"), ("2024-01-05", "2024-01-01")]
    df = spark.createDataFrame(rows, "s string, e string").select(F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    assert column(df, D.clamp_period_end(F.col("s"), F.col("e")).cast("string")) == [
        "2024-01-31", "2024-01-31", "2023-12-31", "2024-01-01",
    ]
    assert column(df, D.valid_period(F.col("s"), F.col("e"))) == [False, True, False, False]


def test_explode_days_skips_inverted_ranges(spark):
    df = spark.sql("SELECT DATE'2024-02-28' AS s, DATE'2024-03-01' AS e UNION ALL SELECT DATE'2024-02-02', DATE'2024-02-01'")
    assert [str(r.day) for r in D.explode_days(df, "s", "e").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_flatten_and_defaults(spark):
    schema = "a struct<__b: int, c: struct<D: string>, list: array<int>>"
    df = spark.createDataFrame([((1, ("x",), [1, 2]),)], schema)
    flat = J.flatten_json(df, "a")
    assert flat.columns == ["b", "c__d", "list"]
    assert J.flatten_json(df, "a", sep="_").columns == ["b", "c_d", "list"]


def test_null_record_keeps_present_values(spark):
    from bazaar.operators.contracts import contract

    schema = contract([{"name": "id", "type": "INTEGER"}, {"name": "in", "type": "RECORD", "fields": [{"name": "x", "type": "STRING"}]}])
    df = spark.createDataFrame([((1, ("a",)),), (None,)], "r struct<id: bigint, in: struct<x: string>>")
    rows = column(df, J.fill_null_record(F.col("r"), schema))
    assert rows[0].id == 1 and rows[0]["in"].x == "a"
    assert rows[1] is not None and rows[1].id is None and rows[1]["in"].x is None


def test_discover_schema(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"b": {"c": "x"}}',), ("broken",)], "j string")
    found = J.discover_schema(df, "j").lower()
    assert "a" in found and "c" in found


PAGE = """<html lang="id"><head><title>T &amp; U</title><meta name="k" content="v"></head>
<body><div class="card big" data-id="1"><span class="n">One <b>bold</b></span><a href="/1">go</a></div>
<div class="big card"><span class="n">Two</span><img src="x.png"></div><p>open<p>next</body></html>"""


def test_element_rules(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "page_id bigint, html string")
    rules = [
        H.Rule("name", "span", "class", "n"),
        H.Rule("second", "span", "class", "n", nth=1),
        H.Rule("card", "div", "class", "card big", take="data-id"),
        H.Rule("link", "a", take="href"),
        H.Rule("inside", "img", take="src", within=("div", "class", "card")),
        H.Rule("outside", "img", take="src", within=("div", "class", "other")),
        H.Rule("meta", "meta", "name", "k", take="content"),
    ]
    rows = sorted((r.field, r.ordinal, r.value) for r in H.extract_elements(df, rules).collect())
    assert rows == [
        ("card", 0, "1"), ("inside", 0, "x.png"), ("link", 0, "/1"), ("meta", 0, "v"),
        ("name", 0, "One bold"), ("name", 1, "Two"), ("second", 1, "Two"),
    ]
    wide = H.extract_fields(df, rules, ["page_id"]).orderBy("page_id").collect()
    assert (wide[0]["name"], wide[0].second, wide[0].outside) == ("One bold", "Two", None)
    assert wide[1]["name"] is None and wide[2].link is None


def test_card_pages(spark):
    from bazaar.plans.page_rules import category_rows, item_rows

    card = (
        '<div class="css-bk6tzz e1nlzfl2"><a class="css-54k5sq" href="https://x?r=https%3A%2F%2Fw.example%2Fshop%2Fitem-1%3Fe">'
        '<span class="css-20kt3o">Sepatu</span><span class="css-o5uqvq">Rp{}</span>{}'
        '<span class="css-ywdpwd">Jakarta</span><span class="css-ywdpwd">Toko A</span></a></div>'
    )
    sale = '<div class="css-rn1hus">10%Rp200.000</div>'
    html = (
        '<h1 class="css-1t4ww55">L2</h1><a class="css-wms9d7">0</a><a class="css-wms9d7">1</a>'
        '<a class="css-wms9d7">L1</a><a class="css-wms9d7">L3</a>' + card.format("150.000", sale) + card.format("99.000", "")
    )
    rows = category_rows(spark.createDataFrame([(7, html)], "page_id bigint, html string"), ["page_id"]).orderBy("card").collect()
    assert [(r.final_price, r.original_price) for r in rows] == [(150000, 200000), (99000, 99000)]
    assert (rows[0].l1_category, rows[0].l3_category, rows[0].store_name) == ("L1", "L3", "Toko A")
    assert (rows[0].store_id, rows[0].product_id) == ("shop", "item-1")

    item = (
        '<meta name="branch:deeplink:$ios_deeplink_path" content="product/1/22">'
        '<div data-testid="lblPDPDetailProductSoldCounter">Terjual 1,2 rb</div>'
        '<span data-testid="lblPDPDetailProductRatingNumber">4.9</span>'
    )
    row = item_rows(spark.createDataFrame([(1, item)], "page_id bigint, html string"), ["page_id"]).first()
    assert (row.product_id, row.sold, row.item_rating, row.stock) == ("22", 1200, 4.9, None)


def test_character_references_never_fail(spark):
    from pyspark.sql import functions as F

    from bazaar.functions.html import strip_tags

    cases = {
        "a&#39;b &#x27; &apos; &#x1F600;": "a'b ' ' \U0001f600",
        "&#9999999; &#xD800; &#0; &#1114112; &#x110000; &nope;": "&#9999999; &#xD800; &#0; &#1114112; &#x110000; &nope;",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "html string").select("html", strip_tags(F.col("html")).alias("t"))
    assert {r.html: r.t for r in rows.collect()} == cases
