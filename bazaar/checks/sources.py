"""Readers. Report files are derived from the tables by Spark and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.fixtures import preamble_lines, workbooks
from bazaar.checks.registry import check, day_text, table
from bazaar.functions import text as X
from bazaar.functions.nested import explode_rows
from bazaar.operators import contracts as C
from bazaar.operators.filters import has_more_than
from bazaar.session import work_folder
from bazaar.sinks import tables as K
from bazaar.sources import files, ledger, payloads, reports
from bazaar.sources.workbooks import workbook_grid

ORDERS_SQL = """
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders
"""
ORDERS_CONTRACT = C.contract(
    {"o_orderkey": "INTEGER", "o_totalprice": "FLOAT", "o_orderdate": "DATE", "o_orderpriority": "STRING"}
)


def order_report(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", day_text(F.col("o_orderdate")).alias("o_orderdate"), "o_orderpriority"
    )


def _typed(raw):
    return C.cast_null_on_error(raw, ORDERS_CONTRACT).withColumn("o_orderdate", day_text(F.col("o_orderdate")))


@check("scan_report_csv", ORDERS_SQL)
def scan_report_csv(spark, d):
    path = work_folder(spark, "report-csv")
    report = order_report(spark, d)
    report.toDF(*[f" {n} " for n in report.columns]).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return _typed(reports.read_report_csv(spark, path))


PREAMBLE = ["Laporan Iklan", "Nama Toko,toko", "Periode,01/01/2024 - 07/01/2024", "", "Status,selesai", ""]


@check("scan_preamble_csv", ORDERS_SQL)
def scan_preamble_csv(spark, d):
    path = work_folder(spark, "preamble-csv")
    preamble_lines(order_report(spark, d), PREAMBLE).write.text(path)
    grid = reports.read_preamble_grid(spark, path)
    return _typed(reports.grid_to_table(grid, reports.grid_header(grid, 6), 7, keep=()))


@check("scan_workbook_grid", ORDERS_SQL)
def scan_workbook_grid(spark, d):
    shown = C.stringify(order_report(spark, d), ["o_orderkey", "o_totalprice"])
    books = workbooks(shown, [["Laporan"], ["Periode", "2024"], [], []], "Penjualan")
    grid = workbook_grid(books, "Penjualan")
    return _typed(reports.grid_to_table(grid, shown.columns, 5, keep=()))


def document_grid(spark, d):
    """Documents as report grids: a row per line, a cell per word."""
    docs = table(spark, d, "documents").withColumnRenamed("doc_id", "path")
    lines = explode_rows(docs, F.split("text", "\n"), ["path"], "line", "row_no")
    return lines.select("path", "row_no", reports.cells_of(F.col("line"), " ").alias("cells"))


@check(
    "grid_to_table",
    """
SELECT doc_id AS path, cells[2] AS nama, cells[3] AS jumlah FROM (
  SELECT doc_id, i - 1 AS row_no, string_split(lines[i], ' ') AS cells FROM (
    SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i))
WHERE row_no >= 2
""",
)
def grid_to_table(spark, d):
    return reports.grid_to_table(document_grid(spark, d), ["nama", "jumlah"], data_row=2, first_col=1)


@check(
    "preamble_value",
    """
WITH grid AS (
  SELECT doc_id, i - 1 AS row_no, string_split(lines[i], ' ') AS cells FROM (
    SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i))
SELECT b.doc_id AS path, b.cells[1] AS head, m.cells[2] AS period FROM grid b
LEFT JOIN grid m ON b.doc_id = m.doc_id AND m.row_no = 0 WHERE b.row_no >= 1
""",
)
def preamble_value(spark, d):
    grid = document_grid(spark, d)
    body = reports.grid_to_table(grid, ["head"], data_row=1)
    return reports.with_preamble_value(body, reports.preamble_value(grid, 0, 1, "period"))


@check(
    "scan_json_payloads",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def scan_json_payloads(spark, d):
    docs = payloads.parse_payload(table(spark, d, "events"), "props", "k bigint")
    return docs.select("event_id", F.col("doc.k").alias("k"))


@check(
    "scan_pages",
    """
SELECT page_id, url, CAST(length(html) AS INTEGER) AS chars, strpos(html, '</html>') > 0 AS whole FROM pages
""",
)
def scan_pages(spark, d):
    pages = payloads.read_pages(spark, f"{d}/pages.parquet")
    return pages.select(
        "page_id", "url", F.length("html").alias("chars"), F.contains("html", F.lit("</html>")).alias("whole")
    )


@check(
    "file_metadata",
    """
SELECT lower(regexp_replace(o_orderpriority, '[^A-Za-z]', '_', 'g')) AS store_folder, count(*) AS n_rows, TRUE AS dated
FROM orders GROUP BY 1
""",
)
def file_metadata(spark, d):
    base = work_folder(spark, "landed")
    orders = table(spark, d, "orders").select("o_orderkey", X.slug(F.col("o_orderpriority")).alias("store"))
    orders.write.partitionBy("store").parquet(f"{base}/assets/excel/market/orders")
    landed = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/assets")
    named = files.with_file_metadata(landed, base)
    return named.groupBy(F.substring_index("store_folder", "=", -1).alias("store_folder")).agg(
        F.count("*").alias("n_rows"), F.bool_and(F.col("upload_tstamp").isNotNull()).alias("dated")
    )


@check(
    "partition_scan",
    """
SELECT o_orderkey, o_totalprice FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-03'
""",
)
def partition_scan(spark, d):
    path = work_folder(spark, "by-month")
    K.append_partitioned(table(spark, d, "orders"), path, "o_orderdate", "MONTH", "run_date")
    return files.select_partition(spark, path, "1996-03").select("o_orderkey", "o_totalprice")


@check(
    "arrival_gate",
    """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n_orders, count(*) > 6 AS arrived,
  (SELECT count(*) > 1000 FROM orders) AS all_arrived, (SELECT count(*) > 1000000000 FROM orders) AS too_many
FROM orders GROUP BY 1
""",
)
def arrival_gate(spark, d):
    """The gate of a whole load, and the same rule day by day."""
    orders = table(spark, d, "orders")
    days = orders.groupBy(day_text(F.col("o_orderdate")).alias("day")).agg(F.count("*").alias("n_orders"))
    gates = {"all_arrived": has_more_than(orders, 1000), "too_many": has_more_than(orders, 1_000_000_000)}
    return days.withColumn("arrived", F.col("n_orders") > 6).withColumns({n: F.lit(x) for n, x in gates.items()})


@check(
    "param_sql",
    """
SELECT o_orderpriority, count(*) AS n_orders FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus = 'F' GROUP BY 1
""",
)
def param_sql(spark, d):
    text = """
        SELECT o_orderpriority, count(*) AS n_orders FROM {orders}
        WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_orderstatus = :status GROUP BY 1
    """
    return files.run_sql(spark, text, {"since": "1996-01-01", "status": "F"}, orders=table(spark, d, "orders"))


@check(
    "union_reports",
    """
SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier
""",
)
def union_reports(spark, d):
    customers = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name")
    )
    return reports.union_reports(customers, suppliers)


@check("path_glob", "SELECT o_orderpriority AS kind, count(*) AS n_rows FROM orders GROUP BY 1")
def path_glob(spark, d):
    path = work_folder(spark, "mixed")
    table(spark, d, "orders").select("o_orderpriority").write.csv(f"{path}/a", header=True)
    table(spark, d, "customer").select("c_name").write.json(f"{path}/b")
    rows = files.read_kind(spark, path, "*.csv", "csv", header="true")
    return rows.groupBy(F.col("o_orderpriority").alias("kind")).agg(F.count("*").alias("n_rows"))


@check(
    "csv_multiline",
    "SELECT doc_id, text, lang FROM documents",
)
def csv_multiline(spark, d):
    """Records with line breaks in quoted cells survive the CSV round trip."""
    path = work_folder(spark, "multiline-csv")
    K.export_csv(table(spark, d, "documents").select("doc_id", "text", "lang"), path)
    return reports.read_report_csv(spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@check(
    "arrival_ledger",
    """
SELECT 'first' AS load, o_orderkey FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'second', o_orderkey FROM orders WHERE o_orderkey % 2 <> 0
UNION ALL SELECT 'again', o_orderkey FROM orders WHERE o_orderkey % 2 = 0
""",
)
def arrival_ledger(spark, d):
    """Two loads, each of what had arrived; a repeat of the first gets the same files, a third load none."""
    base, book = work_folder(spark, "arrived"), work_folder(spark, "ledger")
    orders = table(spark, d, "orders").select("o_orderkey")
    claimed = {}
    for load, part in (("first", "o_orderkey % 2 = 0"), ("second", "o_orderkey % 2 <> 0")):
        orders.where(part).write.mode("append").parquet(base)
        claimed[load] = ledger.paths(ledger.claim(spark, book, base, load, "*.parquet"))
    claimed["again"] = ledger.paths(ledger.claim(spark, book, base, "first", "*.parquet"))
    claimed["third"] = ledger.paths(ledger.claim(spark, book, base, "third", "*.parquet"))
    out = orders.limit(0).select(F.lit("").alias("load"), "o_orderkey")
    for load, paths in claimed.items():
        if paths:
            out = out.union(spark.read.schema(orders.schema).parquet(*paths).select(F.lit(load), "o_orderkey"))
    return out
