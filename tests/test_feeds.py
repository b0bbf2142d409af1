import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaar.checks.fixtures import workbook
from bazaar.operators.contracts import contract
from bazaar.plans import feeds as Fd
from bazaar.plans import payload_feeds as P
from tests.test_sources import put


def test_every_feed_is_well_formed():
    from bazaar.operators.headers import HEADER_STYLES

    for name, feed in Fd.FEEDS.items():
        assert feed.headers in HEADER_STYLES or feed.headers == "camel", name
        assert feed.load == "append" or (feed.keys and feed.order), name


def test_chat_orders_end_to_end(spark, tmp_path):
    feed = Fd.FEEDS["chat_orders"]
    schema = contract(
        {"order_id": "STRING", "sku_id": "STRING", "quantity": "INTEGER", "order_amount": "FLOAT",
         "created_time": "TIMESTAMP", "zipcode": "STRING", "weight_kg": "FLOAT", "store_name": "STRING",
         "load_timestamp": "TIMESTAMP"}
    )
    header = "Order ID,SKU ID,Quantity,Order Amount,Created Time,Zipcode,Weight(kg)\n"
    put(tmp_path / "r", "a.csv", header + '1,s,2,IDR 12.345,"31/12/2023 10:11:12\t",12345\t,0.5\n2,s,x,,never,\t,\n')
    path = str(tmp_path / "t")

    def run(day):
        stamp = F.lit(dt.datetime(2024, 1, day)).cast("timestamp")
        shaped = Fd.shape(Fd.read(spark, feed, str(tmp_path / "r")), feed, schema, store_name="toko", load_timestamp=stamp)
        Fd.load(spark, shaped, feed, path, str(tmp_path / f"s{day}"))

    run(1)
    run(2)
    one, two = spark.read.parquet(path).orderBy("order_id").collect()
    assert (one.quantity, one.order_amount, one.zipcode, one.weight_kg) == (2, 12345.0, "12345", 0.5)
    assert str(one.created_time) == "2023-12-31 10:11:12" and one.load_timestamp.day == 2
    assert (two.quantity, two.order_amount, two.created_time, two.zipcode) == (None, None, None, None)


def test_bilingual_reports_give_the_same_rows(spark, tmp_path):
    feed = Fd.FEEDS["live_analysis"]
    schema = contract({"creator": "STRING", "revenue": "FLOAT", "co_rate": "FLOAT", "acu": "INTEGER",
                       "launched_time": "TIMESTAMP", "avg_viewing_duration": "STRING"})
    body = ["budi", "100.5", "1.2%", "7", "2024/01/02/ 03:04", "5m"]
    heads = {
        "en": ["Creator", "Revenue (Rp)", "CO rate", "ACU", "Launched Time", "Avg. Viewing Duration"],
        "id": ["Kreator", "Penghasilan (Rp)", "CO Rate", "Rata-rata Penonton", "Waktu Live", "Durasi Rata-rata"],
    }
    out = {}
    for lang, head in heads.items():
        put(tmp_path / lang, "r.xlsx", workbook({"S": [["x"], [], head, body]}))
        out[lang] = Fd.shape(Fd.read(spark, feed, str(tmp_path / lang)), feed, schema).collect()
    assert out["en"] == out["id"]
    row = out["id"][0]
    assert (row.revenue, row.co_rate, row.acu, str(row.launched_time)) == (100.5, 1.2, None, "2024-01-02 03:04:00")


def test_period_and_derived_measures(spark, tmp_path):
    region = Fd.FEEDS["buyers_by_region"]
    rows = [["t"], [], ["01/10/2023 - 07/10/2023"], [], [], ["Kota", "Pembeli", "Pesanan"], ["Bogor", "3", "4.0"]]
    put(tmp_path / "a", "r.xlsx", workbook({"Summary": rows}))
    schema = contract({"start_date": "DATE", "end_date": "DATE", "city": "STRING", "total_buyer": "INTEGER",
                       "total_order": "INTEGER", "official_store": "STRING"})
    row = Fd.shape(Fd.read(spark, region, str(tmp_path / "a")), region, schema, official_store="toko").first()
    assert (str(row.start_date), str(row.end_date), row.city, row.total_buyer, row.total_order, row.official_store) == (
        "2023-10-01", "2023-10-07", "Bogor", 3, 4, "toko",
    )

    daily = Fd.FEEDS["buyers_by_day"]
    rows = [["x"], ["Waktu", "Pembeli", "L", "P", "T"], ["02/01/2024", None, "1", "2", "3"], ["03/01/2024", None, "1", None, "3"]]
    put(tmp_path / "b", "r.xlsx", workbook({"Harian": rows}))
    names = ["time_ordered", "total_buyer", "total_male_buyer", "total_female_buyer", "total_unannounced_buyer"]
    schema = contract({n: "DATE" if n == "time_ordered" else "INTEGER" for n in names})
    out = Fd.shape(Fd.read(spark, daily, str(tmp_path / "b")), daily, schema).orderBy("time_ordered").collect()
    assert [r.total_buyer for r in out] == [6, None]

    ads = Fd.FEEDS["product_campaigns"]
    rows = [["Periode", "1 Mei 2023 - 7 Agustus 2023"], [], [], [], ["Nama Produk", "% Klik"], ["a", "5"]]
    put(tmp_path / "c", "r.xlsx", workbook({"Semua Iklan Produk": rows}))
    schema = contract({"start_date": "DATE", "end_date": "DATE", "nama_produk": "STRING", "persentase__klik": "FLOAT"})
    row = Fd.shape(Fd.read(spark, ads, str(tmp_path / "c")), ads, schema).first()
    assert (str(row.start_date), str(row.end_date), row.persentase__klik) == ("2023-05-01", "2023-08-07", 5.0)


def test_zero_on_error_feed_and_preamble_ads(spark, tmp_path):
    feed = Fd.FEEDS["cancelled_orders"]
    put(tmp_path / "a", "r.xlsx", workbook({"S": [["No. Pesanan", "Harga Awal", "Jumlah"], ["1", "Rp1.000", "x"], ["2", None, "3"]]}))
    schema = contract({"no_pesanan": "STRING", "harga_awal": "FLOAT", "jumlah": "INTEGER", "sku_induk": "STRING"})
    out = Fd.shape(Fd.read(spark, feed, str(tmp_path / "a")), feed, schema).orderBy("no_pesanan").collect()
    assert [tuple(r) for r in out] == [("1", 1000.0, 0, None), ("2", 0.0, 3, None)]

    ads = Fd.FEEDS["product_ads"]
    put(tmp_path / "b", "a.csv", "1\n2\n3\n4\n5\n6\nIklan/Toko (x),Biaya\nb,5\n")
    schema = contract({"iklan_atau_toko_x": "STRING", "biaya": "FLOAT"})
    assert tuple(Fd.shape(Fd.read(spark, ads, str(tmp_path / "b")), ads, schema).first()) == ("b", 5.0)


def test_sales_keep_their_rows(spark, tmp_path):
    heads = ["Nomor", "Nomor Invoice", "Nama Produk", "Harga Jual (IDR)", "Nama Pembeli", "Alamat", "Nama Bundling"]
    names = ("nomor", "nomor_invoice", "nama_produk", "harga_jual_idr", "nama_pembeli", "alamat", "nama_bundling")
    feed = dataclasses.replace(Fd.FEEDS["sales"], expected=names)
    schema = contract({"invoice_number": "STRING", "sku_name": "STRING", "selling_price": "INTEGER", "buyer_name": "STRING",
                       "buyer_address": "STRING", "bundle": "STRING", "folder": "STRING", "upload_tstamp": "TIMESTAMP"})
    body = [["1", "i1", "s", "10", "Budi\nBeli Lagi", "Jl. A\nBogor"], ["2", "i2", "s", "20", "Ani", "x"], ["3", "i3", "t", "5", None, None]]

    def loaded(name, head, rows):
        put(tmp_path / name, "r.xlsx", workbook({"Lain": [["x"]], "Laporan Penjualan": [[], [], [], [], head, *rows]}))
        stamp = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
        raw = Fd.read(spark, feed, str(tmp_path / name))
        return Fd.shape(raw, feed, schema, folder="f", upload_tstamp=stamp)

    rows = loaded("short", heads[:-1], body)  # without the optional column
    Fd.load(spark, rows, feed, str(tmp_path / "t"), str(tmp_path / "s"))
    got = spark.read.parquet(str(tmp_path / "t")).orderBy("invoice_number").collect()
    assert [(r.invoice_number, r.selling_price, r.bundle) for r in got] == [("i1", 10, None), ("i2", 20, None), ("i3", 5, None)]
    assert (got[0].buyer_name, got[0].buyer_address) == ("Budi ", "Jl. A Bogor")
    with pytest.raises(ValueError, match="unknown"):
        loaded("more", [*heads, "Baru"], [[*r, None, "x"] for r in body])
    with pytest.raises(ValueError, match="lacks"):
        loaded("less", heads[:2], [r[:2] for r in body])


def test_a_report_without_a_merge_key_is_refused(spark):
    feed = Fd.FEEDS["item_orders"]
    with pytest.raises(ValueError, match="order_item_id"):
        Fd.shape(spark.createDataFrame([("1",)], "other string"), feed, contract({"order_item_id": "STRING"}), store_name="x")


def test_rows_read_every_file_by_its_header(spark, tmp_path):
    """The lazy path: mixed languages, refusals when a file is read and not before, no job while planning."""
    from tests.test_records import jobs_of

    feed = Fd.FEEDS["live_analysis"]
    schema = contract({"creator": "STRING", "revenue": "FLOAT", "launched_time": "TIMESTAMP", "store_name": "STRING"})
    heads = {"en": ["Creator", "Revenue (Rp)", "Launched Time"], "id": ["Waktu Live", "Kreator", "Penghasilan (Rp)"]}
    for lang, head in heads.items():
        body = {"en": ["ann", "1.5", "2024/01/02/ 03:04"], "id": ["2024/01/02/ 03:04", "budi", "2.5"]}[lang]
        put(tmp_path / "both", f"{lang}.xlsx", workbook({"S": [["x"], [], head, body]}))
    df, jobs = jobs_of(spark, lambda: Fd.rows(spark, feed, str(tmp_path / "both"), schema, store_name="t"))
    assert jobs == 0
    assert [(r.creator, r.revenue, str(r.launched_time), r.store_name) for r in df.orderBy("creator").collect()] == [
        ("ann", 1.5, "2024-01-02 03:04:00", "t"), ("budi", 2.5, "2024-01-02 03:04:00", "t"),
    ]

    chats = Fd.FEEDS["chat_orders"]
    wanted = contract({"order_id": "STRING", "sku_id": "STRING", "quantity": "INTEGER", "store_name": "STRING"})
    put(tmp_path / "csv", "a.csv", 'Order ID,Quantity,SKU ID\n1,2,"s\nt"\n')
    assert [tuple(r) for r in Fd.rows(spark, chats, str(tmp_path / "csv"), wanted, store_name="t").collect()] == [("1", "s\nt", 2, "t")]
    put(tmp_path / "csv", "b.csv", "Order ID,Quantity\n1,2\n")
    with pytest.raises(Exception, match=r'b.csv is refused: it lacks ."sku_id'):
        Fd.rows(spark, chats, str(tmp_path / "csv"), wanted, store_name="t").collect()


def test_positional_reports_need_all_columns(spark, tmp_path):
    feed = Fd.FEEDS["buyers_by_region"]
    schema = contract({"start_date": "DATE", "end_date": "DATE", "city": "STRING", "total_buyer": "INTEGER",
                       "total_order": "INTEGER", "official_store": "STRING"})

    def book(name, head, *rows):
        cells = [["t"], [], ["01/10/2023 - 07/10/2023"], [], [], head, *rows]
        put(tmp_path / name, "r.xlsx", workbook({"Summary": cells}))
        return str(tmp_path / name)

    good = Fd.rows(spark, feed, book("good", ["Kota", "Pembeli", "Pesanan"], ["Bogor", "3", "4"]), schema, official_store="t")
    assert [(str(r.start_date), r.city, r.total_buyer, r.total_order) for r in good.collect()] == [("2023-10-01", "Bogor", 3, 4)]
    short = book("short", ["Kota", "Pesanan"], ["Bogor", "4"])
    with pytest.raises(ValueError, match="2 columns"):
        Fd.shape(Fd.read(spark, feed, short), feed, schema, official_store="t")
    with pytest.raises(Exception, match="refused: it has 2 columns"):
        Fd.rows(spark, feed, short, schema, official_store="t").collect()


def test_sales_by_the_library_headers(spark, tmp_path):
    from bazaar.plans.vocabularies import SALES_HEADERS

    feed = Fd.FEEDS["sales"]
    names = [n for n in SALES_HEADERS if n != "nomor"]
    schema = contract({n: "STRING" for n in [*names, "folder"]})
    head = [n.replace("_", " ").title() for n in reversed(SALES_HEADERS) if n not in feed.optional]

    def book(name, head):
        put(tmp_path / name, "r.xlsx", workbook({"Laporan Penjualan": [[], [], [], [], head, [f"v{h}" for h in head]]}))
        return Fd.rows(spark, feed, str(tmp_path / name), schema, folder="f")

    row = book("a", head).first()
    assert row.nomor_invoice == "vNomor Invoice" and row.nama_bundling is None and row.folder == "f"
    with pytest.raises(Exception, match="lacks .*kota.* unknown .*baru"):
        book("b", ["Baru", *[h for h in head if h != "Kota"]]).collect()


def test_load_asks_for_every_key(spark, tmp_path):
    feed = Fd.Feed(reader="csv", load="merge", keys=("k", "day"), order=("n",))
    schema = contract({"k": "STRING", "day": "STRING", "n": "INTEGER"})
    rows = Fd.shape(spark.createDataFrame([("a", "1"), ("a", "2")], "k string, n string"), feed, schema)
    with pytest.raises(ValueError, match="day"):
        Fd.load(spark, rows, feed, str(tmp_path / "t"), str(tmp_path / "s"))


def docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def test_catalogue_search_payload(spark):
    wanted = contract(
        [
            {"name": "load_day", "type": "STRING"}, {"name": "itemid", "type": "INTEGER"}, {"name": "image", "type": "STRING"},
            {"name": "price", "type": "INTEGER"}, {"name": "price_min", "type": "INTEGER"}, {"name": "stock", "type": "INTEGER"},
            {"name": "bundle_deal_info", "type": "RECORD", "fields": [{"name": "bundle_deal_id", "type": "INTEGER"}]},
        ]
    )
    schema = (
        "items array<struct<item_basic: struct<itemid bigint, image string, price bigint, price_min bigint, "
        "bundle_deal_info: struct<bundle_deal_id: bigint>>>>"
    )
    text = (
        '{"items": [{"item_basic": {"itemid": 1, "image": "ab", "price": 1250000, "price_min": -1, "extra": 1}},'
        ' {"item_basic": {"itemid": 2, "price": 0, "bundle_deal_info": {"bundle_deal_id": 9}}}]}'
    )
    rows = P.shape_payload(
        docs(spark, text, "{}"), P.PAYLOAD_FEEDS["catalogue_search"], schema, wanted, "https://i/", load_day="d"
    ).orderBy("itemid").collect()
    assert (rows[0].price, rows[0].price_min, rows[0].image, rows[0].stock) == (12, -1, "https://i/ab", None)
    assert rows[0].bundle_deal_info.bundle_deal_id is None and rows[1].bundle_deal_info.bundle_deal_id == 9
    assert rows[1].image is None and len(rows) == 2 and rows[0].load_day == "d"


def test_other_payload_shapes(spark):
    flat = P.shape_payload(
        docs(spark, '{"mods": {"listItems": [{"Name": "a", "seller": {"__id": 3}}]}}'),
        P.PAYLOAD_FEEDS["catalogue_list_items"], "mods struct<listItems: array<struct<Name: string, seller: struct<__id: int>>>>",
        contract({"name": "STRING", "seller__id": "INTEGER"}),
    ).first()
    assert tuple(flat) == ("a", 3)
    recommended = P.shape_payload(
        docs(spark, '{"data": {"sections": [{"data": {"item": [{"price": 250000, "size_chart": ["x"]}]}}]}}'),
        P.PAYLOAD_FEEDS["catalogue_recommended"],
        "data struct<sections: array<struct<data: struct<item: array<struct<price: bigint, size_chart: array<string>>>>>>>",
        contract({"price": "INTEGER", "size_chart": "STRING"}),
    ).first()
    assert tuple(recommended) == (2, '["x"]')
    products = P.shape_payload(
        docs(spark, '{"data": {"products": [{"id": "p", "images": ["a", "b"], "soldRangeCount": {"id": "s", "en": "e"}, "price": {"show": "1"}}]}}'),
        P.PayloadFeed(items="data.products", joined=("images",), unfold=("price", "soldRangeCount"),
                      renames=P.PAYLOAD_FEEDS["catalogue_products"].renames),
        "data struct<products: array<struct<id: string, images: array<string>, soldRangeCount: struct<id: string, en: string>, price: struct<show: string>>>>",
        contract({"productId": "STRING", "images": "STRING", "soldRangeCountId": "STRING", "show": "STRING"}),
    ).first()
    assert tuple(products) == ("p", "a,b", "s", "1")
    brands = P.shape_brands(
        docs(spark, '{"data": {"brands": [{"brand_ids": [{"username": "u"}, {"username": "v"}]}, {"brand_ids": []}]}}'),
        "data struct<brands: array<struct<brand_ids: array<struct<username: string>>>>>", "https://m/",
    )
    assert {r.brand_url for r in brands.collect()} == {"https://m/u", "https://m/v"}
    layout = P.shape_layout(
        docs(spark, '{"data": {"pdpGetLayout": {"basicInfo": {"id": 1, "category": {"name": "c"}}, "components": '
                    '[{"name": "media", "data": []}, {"name": "product_content", "data": [{"title": "t"}]}]}}}'),
        "data struct<pdpGetLayout: struct<basicInfo: struct<id: int, category: struct<name: string>>, "
        "components: array<struct<name: string, data: array<struct<title: string>>>>>>",
        contract({"id": "INTEGER", "category__name": "STRING", "title": "STRING", "load": "STRING"}), load="d",
    ).first()
    assert tuple(layout) == (1, "c", "t", "d")


_TAGS = {"official_store": "t", "store_name": "t", "folder": "t"}


def _report_of(feed):
    """Columns, cells of two rows and preamble of a small report that the feed declares."""
    own = [k for k in feed.keys if k not in _TAGS and k not in ("start_date", "end_date")]
    derived = [*feed.sums, *feed.remainders]
    parts = [p for ps in (*feed.sums.values(), *feed.remainders.values()) for p in ps]
    if feed.expected:
        columns = list(feed.expected)
    else:
        columns = list(dict.fromkeys([*own, "jumlah", *[n for n in feed.optional if not feed.positional], *parts, *derived]))
    before = [["x"] for _ in range(feed.header_row)]
    period = None
    if feed.period:
        row, col, fmt, sep, prefix = feed.period
        day = {"id": "1 Mei 2023", "yyyy-M-d": "2023-5-1", "d/M/yyyy": "1/5/2023"}[fmt]
        period = f"{prefix}{day}{sep}{day}"
        if feed.period_sheet is None:
            before[row] = [None] * col + [period]
    return columns, before, period


@pytest.mark.parametrize("name", sorted(Fd.FEEDS))
def test_every_declared_feed_reads_its_report(spark, tmp_path, name):
    feed = Fd.FEEDS[name]
    columns, before, period = _report_of(feed)
    wanted = [c for c in columns if c not in feed.dropped]
    kinds = {c: "INTEGER" if c == "jumlah" or c in feed.sums or c in feed.remainders else "STRING" for c in wanted}
    kinds |= {p: "INTEGER" for ps in (*feed.sums.values(), *feed.remainders.values()) for p in ps}
    if feed.period:
        kinds |= {"start_date": "DATE", "end_date": "DATE"}
    schema = contract(kinds | {k: "STRING" for k in _TAGS})
    rows = [[str(10 * r + i) for i in range(len(columns))] for r in (1, 2)]
    if feed.first_header:
        columns = ["Kolom", *columns[1:]]
    if feed.reader == "grid":
        sheet = feed.sheet if isinstance(feed.sheet, str) else "Satu"
        sheets = {sheet: [*before, columns, *rows]}
        if feed.period_sheet is not None:
            row, col, *_ = feed.period
            sheets[feed.period_sheet] = [*[["x"] for _ in range(row)], [None] * col + [period]]
        put(tmp_path / "r", "a.xlsx", workbook(sheets))
    else:
        lines = [",".join(cell or "" for cell in line) for line in [*before, columns, *rows]]
        put(tmp_path / "r", "a.csv", "\n".join(lines) + "\n")
    got = Fd.rows(spark, feed, str(tmp_path / "r"), schema, **_TAGS).collect()
    assert len(got) == 2 and all(r.store_name == "t" for r in got)
    if feed.period:
        assert {(str(r.start_date), str(r.end_date)) for r in got} == {("2023-05-01", "2023-05-01")}
    if "jumlah" in kinds and not feed.always_null:
        at = columns.index("jumlah")
        assert sorted(r.jumlah for r in got) == [10 + at, 20 + at]
    for name_, parts in feed.sums.items():
        assert all(r[name_] == sum(r[p] for p in parts) for r in got)
