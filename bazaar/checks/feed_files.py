"""Whole feeds over report files of differing headers, built from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.fixtures import sheet_books, workbooks
from bazaar.checks.registry import check, day_text, minute_text, table
from bazaar.operators.contracts import contract
from bazaar.plans import feeds as Fd
from bazaar.plans.vocabularies import SALES_HEADERS
from bazaar.session import work_folder
from bazaar.sources.workbooks import workbook_grid


def _books(frames, preamble, sheet):
    """Workbooks with the sheet; each frame has its own header."""
    books = None
    for i, frame in enumerate(frames):
        path = F.concat(F.lit(f"{i}-"), F.monotonically_increasing_id(), F.lit("-"), F.col("path"))
        own = workbooks(frame, preamble, sheet).withColumn("path", path)
        books = own if books is None else books.union(own)
    return books


@check(
    "feed_bilingual",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS creator_id, o_totalprice AS revenue, CAST(o_custkey AS BIGINT) AS orders_created,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS launched_time, CAST(NULL AS BIGINT) AS acu,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS nickname
FROM orders
""",
)
def feed_bilingual(spark, d):
    """English and Indonesian reports with differing columns and orders of them, read together."""
    orders = table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy/MM/dd/ HH:mm")
    key, total, count = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"), F.col("o_custkey").cast("string")
    english = orders.where("o_orderkey % 2 = 0").select(
        key.alias("Creator ID"), F.col("o_orderpriority").alias("Nickname"), total.alias("Revenue (Rp)"),
        count.alias("Orders Created"), day.alias("Launched Time"), count.alias("ACU"),
    )
    indonesian = orders.where("o_orderkey % 2 <> 0").select(
        day.alias("Waktu Live"), count.alias("Pesanan Dibuat"), key.alias("Creator ID"), total.alias("Penghasilan (Rp)"),
    )
    schema = contract(
        {"creator_id": "STRING", "revenue": "FLOAT", "orders_created": "INTEGER", "launched_time": "TIMESTAMP",
         "acu": "INTEGER", "nickname": "STRING"}
    )
    grid = workbook_grid(_books([english, indonesian], [["Laporan"], []], "Live"), "Live")
    rows = Fd.shape_grid(grid, Fd.FEEDS["live_analysis"], schema)
    return rows.withColumn("launched_time", minute_text(F.col("launched_time")))


#: Contract names of the sales columns that are not called like their headers.
SALES_NAMES = {"nomor_invoice": "invoice_number", "nama_produk": "sku_name", "harga_jual_idr": "selling_price"}


@check(
    "feed_sales",
    """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS invoice_number,
  CAST(l_partkey AS VARCHAR) AS sku_name, CAST(l_quantity AS BIGINT) AS selling_price,
  CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus END AS nama_bundling, 'Jl. ' || l_returnflag || ' kota' AS buyer_address,
  'toko' AS folder
FROM lineitem
""",
)
def feed_sales(spark, d):
    """Sales reports with and without the optional columns, in any order, by the library's header list."""
    feed = Fd.FEEDS["sales"]
    items = table(spark, d, "lineitem")
    filled = {
        "nomor": F.lit("1"),
        "nomor_invoice": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "nama_produk": F.col("l_partkey").cast("string"),
        "harga_jual_idr": F.col("l_quantity").cast("bigint").cast("string"),
        "nama_bundling": F.col("l_linestatus"),
        "alamat_pengiriman": F.concat(F.lit("Jl. "), "l_returnflag", F.lit("\nkota")),
    }
    shown = lambda n: filled.get(n, F.lit(None).cast("string")).alias(n.replace("_", " ").title())
    whole = items.where("l_linenumber % 2 = 0").select(*[shown(n) for n in SALES_HEADERS])
    short = items.where("l_linenumber % 2 <> 0").select(*[shown(n) for n in reversed(SALES_HEADERS) if n not in feed.optional])
    names = [SALES_NAMES.get(n, "buyer_address" if n == "alamat_pengiriman" else n) for n in SALES_HEADERS if n != "nomor"]
    schema = contract({n: "INTEGER" if n == "selling_price" else "STRING" for n in [*names, "folder"]})
    books = _books([whole, short], [["x"], [], [], []], "Laporan Penjualan")
    rows = Fd.shape_books(books, {"sales": feed}, {"sales": schema}, folder="toko")["sales"]
    return rows.select("invoice_number", "sku_name", "selling_price", "nama_bundling", "buyer_address", "folder")


@check(
    "feed_positional",
    """
SELECT '2024-01-01' AS start_date, '2024-01-07' AS end_date, c_name AS city, CAST(c_nationkey AS BIGINT) AS total_buyer,
  CAST(c_custkey AS BIGINT) AS total_order, 'toko' AS official_store
FROM customer
""",
)
def feed_positional(spark, d):
    """Columns by their places, dated by the period cell of the same sheet."""
    buyers = table(spark, d, "customer").select(
        F.col("c_name").alias("Kota"), F.col("c_nationkey").cast("string").alias("Pembeli"), F.col("c_custkey").cast("string").alias("Pesanan"),
    )
    schema = contract(
        {"start_date": "DATE", "end_date": "DATE", "city": "STRING", "total_buyer": "INTEGER", "total_order": "INTEGER",
         "official_store": "STRING"}
    )
    grid = workbook_grid(_books([buyers], [["x"], [], ["01/01/2024 - 07/01/2024"], [], []], "Summary"), "Summary")
    rows = Fd.shape_grid(grid, Fd.FEEDS["buyers_by_region"], schema, official_store="toko")
    return rows.withColumns({c: day_text(F.col(c)) for c in ("start_date", "end_date")})


@check(
    "feed_traffic",
    """
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS nama_produk, o_custkey, o_orderdate FROM orders),
times AS (
  SELECT unnest(['viewed', 'conversion']) AS kind, strftime(o_orderdate, '%Y-%m-%d') AS waktu, NULL AS nama_produk,
    CAST(o_custkey AS BIGINT) AS pencarian, NULL AS start_date, NULL AS end_date FROM o),
products AS (
  SELECT unnest(['viewed', 'conversion']) AS kind, NULL AS waktu, nama_produk, CAST(o_custkey AS BIGINT) AS pencarian,
    '2024-01-01' AS start_date, '2024-01-07' AS end_date FROM o)
SELECT *, 'toko' AS official_store, CAST(NULL AS BIGINT) AS flash_sale FROM times UNION ALL SELECT *, 'toko', NULL FROM products
""",
)
def feed_traffic(spark, d):
    """Four sheets to four tables and the period from a fifth, from one parse of each workbook."""
    shown = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("Barang"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("Tanggal"),
        F.col("o_custkey").cast("string").alias("Pencarian (SEO)"),
    )
    before = [["Trafik"], []]
    sheets = {
        f"{title} - Rincian {by}": (before, [first, "Pencarian (SEO)"])
        for title in ("Konversi", "Produk Dilihat") for by, first in (("Waktu", "Tanggal"), ("Produk", "Barang"))
    }
    books = sheet_books(shown, sheets, {"Ringkasan": [["Trafik"], ["01/01/2024 - 07/01/2024"]]})
    names = [n for n in Fd.FEEDS if n.startswith(("traffic_viewed", "traffic_conversion"))]
    columns = {"pencarian": "INTEGER", "flash_sale": "INTEGER", "official_store": "STRING"}
    time = contract({"waktu": "DATE", **columns})
    product = contract({"start_date": "DATE", "end_date": "DATE", "nama_produk": "STRING", **columns})
    schemas = {n: time if n.endswith("time") else product for n in names}
    tables = Fd.shape_books(
        books, {n: Fd.FEEDS[n] for n in names}, schemas, work_folder(spark, "traffic"), official_store="toko"
    )
    out = None
    for name, rows in tables.items():
        days = [c for c in ("waktu", "start_date", "end_date") if c in rows.columns]
        rows = rows.withColumns({c: day_text(F.col(c)) for c in days}).withColumn("kind", F.lit(name.split("_")[1]))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
