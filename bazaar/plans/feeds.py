"""Dataset feeds: each report family as a short declaration.

A feed names its reader, header rule, cleaning rules, keys and how its rows
reach the table; ``shape`` turns raw report rows into contract rows and
``load`` puts them into the table. Contracts are the caller's (their JSON is the
table's schema); cleaning rules address columns by name or by contract type.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions import dates as D
from bazaar.functions import numbers as N
from bazaar.functions import text as X
from bazaar.operators import contracts as C
from bazaar.operators import headers as Hd
from bazaar.plans import vocabularies as V
from bazaar.sinks import tables as K
from bazaar.sources import reports as R
from bazaar.sources import workbooks as W
from bazaar.sources.workbooks import read_workbook_grid


@dataclass(frozen=True)
class Feed:
    """How one report family is read, cleaned and stored.

    ``reader`` is csv, csv_preamble or grid; ``header_row``, ``skip_rows`` (rows
    between header and data) and ``sheet`` place the table in a grid.
    ``headers`` is a header style, ``positional`` takes names from the contract
    instead; then the report has to have exactly as many columns as the contract
    names (derived measures may be absent). ``expected`` lists a positional
    report's headers in the contract's order: columns are found by them,
    ``optional`` ones may be absent, any other difference is refused.
    ``dropped`` headers have no contract column. ``one_line`` and ``first_line``
    name contract columns whose line breaks become blanks, in the second case
    with the words after them. ``sums`` and ``remainders`` derive measures from contract columns.
    ``invalid`` says what a bad number becomes: null or zero. ``period`` places
    the report's date range: (row, column, date layout, separator, prefix), on
    the sheet ``period_sheet`` if that is another one; the dates then come as
    start_date and end_date where the contract has them. ``first_header``
    replaces the text of the first header cell.
    ``load`` is append, merge (NULL keys match) or merge_strict.
    """

    reader: str = "grid"
    header_row: int = 0
    sheet: str | int = 0
    headers: str = "words"
    vocabulary: dict[str, str] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)
    positional: bool = False
    expected: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    one_line: tuple[str, ...] = ()
    first_line: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    sentinels: tuple[str, ...] = X.MISSING_WORDS
    money: tuple[str, ...] = ()
    money_types: tuple[str, ...] = ()
    percent: tuple[str, ...] = ()
    sums: dict[str, tuple[str, ...]] = field(default_factory=dict)
    remainders: dict[str, tuple[str, ...]] = field(default_factory=dict)
    date_formats: tuple[str, ...] = ()
    always_null: tuple[str, ...] = ()
    invalid: str = "null"
    period: tuple[int, int, str, str, str] | None = None
    period_sheet: str | int | None = None
    first_header: str | None = None
    load: str = "append"
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    keep: str = "oldest"
    partition: tuple[str, str] | None = None


_ISO = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-M-d")
_DAY = (D.REPORT_FORMATS["day_first"],)
_DASH_DAY = ("d-M-yyyy",)
_TRAFFIC_OPTIONAL = ("kejar_diskon_spesial", "kejar_diskon", "deal_of_the_day", "flash_sale")
_LATEST = {"keep": "latest"}

# Header rows, sheets, key columns and layouts of the report families.
FEEDS: dict[str, Feed] = {
    "chat_orders": Feed(
        reader="csv",
        money=(
            "sku_unit_original_price", "sku_subtotal_before_discount", "sku_platform_discount",
            "sku_seller_discount", "sku_subtotal_after_discount", "shipping_fee_after_discount",
            "original_shipping_fee", "shipping_fee_seller_discount", "shipping_fee_platform_discount",
            "taxes", "order_amount", "order_refund_amount",
        ),
        date_formats=(D.REPORT_FORMATS["day_first_seconds"],),
        load="merge_strict", keys=("order_id", "sku_id", "store_name"), order=("load_timestamp",), **_LATEST,
    ),
    "shop_overview_v1": Feed(
        header_row=2, headers="metric", vocabulary=V.OVERVIEW_V1_INDONESIAN,
        percent=("negative_review_rate", "rate_of_returns_for_quality_reasons", "complaint_rate"),
        date_formats=(D.REPORT_FORMATS["month_first_dash"],),
    ),
    "shop_overview_v2": Feed(
        header_row=4, headers="metric", vocabulary=V.OVERVIEW_V2_INDONESIAN,
        percent=("conversion_rate",), date_formats=_ISO,
    ),
    "live_analysis": Feed(
        header_row=2, headers="metric", vocabulary=V.LIVE_INDONESIAN, percent=("co_rate", "ctr"),
        always_null=("acu", "pcu"), date_formats=(D.REPORT_FORMATS["year_first_slash_minutes"],),
    ),
    "product_analysis": Feed(
        header_row=2, headers="collapse", vocabulary=V.PRODUCT_INDONESIAN,
        period=(0, 0, "yyyy-M-d", "~", "[Date Range]: "), date_formats=_ISO,
    ),
    "service_analysis": Feed(header_row=2, headers="collapse", vocabulary=V.SERVICE_INDONESIAN, date_formats=_ISO),
    "video_analysis": Feed(
        header_row=2, headers="collapse", vocabulary=V.VIDEO_INDONESIAN,
        date_formats=(D.REPORT_FORMATS["year_first_seconds"],),
    ),
    "item_orders": Feed(
        sheet=0, headers="camel", date_formats=(D.REPORT_FORMATS["short_month_minutes"],),
        load="merge", keys=("order_item_id", "store_name"), order=("upload_tstamp",),
    ),
    "marketplace_orders": Feed(
        headers="slash_marks", vocabulary=V.MARKETPLACE_ORDERS, money_types=("FLOAT",), date_formats=_ISO
    ),
    "cancelled_orders": Feed(
        headers="slash_marks", money_types=("FLOAT",), invalid="zero", date_formats=_ISO, load="merge",
        keys=("no_pesanan", "waktu_pesanan_dibuat", "sku_induk", "folder"), order=("load_timestamp",), **_LATEST,
    ),
    "returned_orders": Feed(
        headers="slash_marks", money_types=("FLOAT",), invalid="zero", date_formats=_ISO, load="merge",
        keys=("no_pengembalian", "no_pesanan", "tanggal_pesanan_dibuat", "sku_induk", "folder"),
        order=("load_timestamp",), **_LATEST,
    ),
    "raw_fulfilment": Feed(
        headers="slash_marks_dash", money_types=("FLOAT",), invalid="zero", date_formats=_ISO
    ),
    "non_fulfilled": Feed(
        headers="marks", money_types=("INTEGER",), date_formats=(D.REPORT_FORMATS["day_first_offset"],),
        load="merge_strict", keys=("no_pesanan", "folder"), order=("upload_timestamp",), **_LATEST,
    ),
    "visitor_traffic": Feed(
        header_row=3, headers="brackets", date_formats=_DASH_DAY,
        load="merge_strict", keys=("tanggal", "folder"), order=("upload_timestamp",), **_LATEST,
    ),
    "store_performance": Feed(
        headers="brackets", date_formats=_DASH_DAY,
        load="merge_strict", keys=("tanggal", "folder"), order=("upload_timestamp",), **_LATEST,
    ),
    "live_stream": Feed(
        sheet="Daftar Streaming", headers="stream", money_types=("FLOAT",), invalid="zero",
        date_formats=(D.REPORT_FORMATS["day_first_dash_minutes"],), load="merge",
        keys=("folder", "waktu_dimulai"), order=("load_timestamp",), **_LATEST,
    ),
    "live_stream_detail": Feed(
        headers="stream", money_types=("FLOAT",), invalid="zero",
        date_formats=(D.REPORT_FORMATS["day_first_dash_minutes"],), load="merge",
        keys=("folder", "waktu_dimulai"), order=("load_timestamp",), **_LATEST,
    ),
    "product_ads": Feed(reader="csv_preamble", header_row=6, headers="slash_or"),
    "affiliate_conversions": Feed(
        reader="csv", headers="collapse", date_formats=_ISO,
        renames={
            "hargarp": "harga_rp",
            "nilai_pembelianrp": "nilai_pembelian_rp",
            "jumlah_pengembalianrp": "jumlah_pengembalian_rp",
            "partner_promo": "partner_kampanye",
        },
    ),
    "sales": Feed(
        sheet="Laporan Penjualan", header_row=4, headers="plain", positional=True,
        expected=V.SALES_HEADERS, dropped=("nomor",),
        one_line=("buyer_address",), first_line=("buyer_name",),
        optional=(
            "harga_satuan_bundling_idr", "gudang_pengiriman", "nama_bundling",
            "jumlah_produk_yang_dikurangkan", "total_pengurangan_idr",
        ),
        load="merge", keys=("invoice_number", "sku_name", "selling_price"), order=("upload_tstamp",),
        partition=("upload_tstamp", "DAY"),
    ),
    "product_campaigns": Feed(
        sheet="Semua Iklan Produk", header_row=4, headers="percent_word", period=(0, 1, "id", " - ", "")
    ),
    "shop_campaigns": Feed(sheet="Iklan Toko", header_row=4, headers="percent_word", period=(0, 1, "id", " - ", "")),
    "buyers_by_region": Feed(
        sheet="Summary", header_row=5, positional=True, period=(2, 0, "d/M/yyyy", " - ", ""),
        load="merge", keys=("start_date", "end_date", "city", "official_store"), order=("upload_tstamp",),
    ),
    "buyers_by_day": Feed(
        sheet="Harian", header_row=1, positional=True, date_formats=_DAY,
        sums={"total_buyer": ("total_male_buyer", "total_female_buyer", "total_unannounced_buyer")},
        load="merge", keys=("time_ordered", "official_store"), order=("upload_tstamp",),
    ),
    "shop_detail": Feed(
        positional=True, date_formats=_DAY,
        sums={
            "pesanan_batal": ("pesanan_batal_dari_pembeli", "pesanan_batal_dari_seller", "pesanan_batal_otomatis"),
            "estimasi_pengeluaran": (
                "bebas_ongkir", "biaya_layanan", "biaya_topads", "biaya_broadcast_chat", "biaya_kupon_toko",
            ),
        },
        remainders={
            "potensi_penjualan_exc_bebas_ongkir": (
                "potensi_penjualan", "potensi_penjualan_bebas_ongkir", "potensi_penjualan_dilayani_tkpd",
            ),
            "pesanan_baru_exc_bebas_ongkir": (
                "pesanan", "pesanan_baru_bebas_ongkir", "pesanan_baru_dilayani_tkpd",
            ),
        },
        load="merge", keys=("waktu", "official_store"), order=("upload_tstamp",),
    ),
    "product_statistic": Feed(
        header_row=9, positional=True, period=(0, 1, "d/M/yyyy", " - ", ""), load="merge",
        keys=("start_date", "end_date", "official_store", "nama_produk"), order=("upload_tstamp",),
    ),
    "traffic_by_time": Feed(
        header_row=2, headers="seo", optional=_TRAFFIC_OPTIONAL, date_formats=_DAY, load="merge",
        keys=("waktu", "official_store"), order=("upload_tstamp",),
    ),
    "traffic_by_product": Feed(
        header_row=2, headers="seo", optional=_TRAFFIC_OPTIONAL, date_formats=_ISO, load="merge",
        keys=("nama_produk", "official_store", "start_date", "end_date"), order=("upload_tstamp",),
    ),
    **{
        f"traffic_{kind}_by_{by}": Feed(
            sheet=f"{title} - Rincian {'Waktu' if by == 'time' else 'Produk'}", header_row=2, headers="seo",
            optional=_TRAFFIC_OPTIONAL, date_formats=_DAY if by == "time" else _ISO, load="merge",
            first_header="waktu" if by == "time" else "nama_produk",
            period=(1, 0, "d/M/yyyy", " - ", ""), period_sheet="Ringkasan",
            keys=("waktu", "official_store") if by == "time" else ("nama_produk", "official_store", "start_date", "end_date"),
            order=("upload_tstamp",),
        )
        for kind, title in (("viewed", "Produk Dilihat"), ("conversion", "Konversi"))
        for by in ("time", "product")
    },
    "video_statistic": Feed(
        sheet="wawasan video", header_row=10, positional=True, date_formats=("yyyy/M/d",), load="merge",
        keys=("judul", "waktu_dibuat", "store_name"), order=("load_timestamp",),
    ),
}


def rows(spark: SparkSession, feed: Feed, paths: list[str] | str, schema: T.StructType, **tags: object) -> DataFrame:
    """Contract rows of all report files below the paths; nothing runs while the plan is built.

    Every file (and sheet) is read by its own header, so languages, column
    orders and optional columns mix in one read. A file is refused when it is
    read if it lacks a header row, a key by which its rows are merged or, for a
    positional report, has other columns than expected. A workbook is parsed
    once: header, period cell and body come from the same pass.
    """
    if feed.reader == "grid":
        return shape_books(W.workbook_files(spark, paths), {"": feed}, {"": schema}, **tags)[""]
    return shape_grid(grid_of(spark, feed, paths), feed, schema, **tags)


def shape_books(
    files: DataFrame, feeds: dict[str, Feed], schemas: dict[str, T.StructType], staging: str | None = None, **tags: object
) -> dict[str, DataFrame]:
    """Contract rows of several feeds that stand in the same workbooks (path, content).

    With ``staging`` the files are parsed once for all feeds: the rows are
    stored there, a folder for each feed, which also ends the lineage. Without
    it each frame that is used parses them.
    """
    rules = {name: _rule(feed, schemas[name], tags) for name, feed in feeds.items()}
    found = W.sheet_rows(files, rules)
    if staging is not None:
        found.write.mode("overwrite").partitionBy("rule").parquet(staging)
        found = files.sparkSession.read.schema(W.ROWS_SCHEMA).parquet(staging)
    out = {}
    for name, feed in feeds.items():
        body = W.rule_table(found, name, rules[name])
        if feed.period:
            body = _dated(body, feed)
        out[name] = _typed_rows(C.tag(_lines(body.drop("path"), feed), **tags), feed, schemas[name])
    return out


def _own_columns(feed: Feed, schema: T.StructType, tags: Iterable[str]) -> list[str]:
    """Contract columns that come from the report's body."""
    dated = ("start_date", "end_date") if feed.period else ()
    return [n for n in schema.fieldNames() if n not in tags and n not in dated]


def _rule(feed: Feed, schema: T.StructType, tags: dict[str, object]) -> W.SheetRule:
    """Where a feed's table stands in a workbook, and how its headers give the wanted columns."""
    wanted = _own_columns(feed, schema, tags)
    keys = [k for k in feed.keys if k in wanted]

    def by_place(header: list[str]) -> list[list[int]]:
        layouts = {len(names): names for names in reversed(_layouts(wanted, feed))}
        if len(header) not in layouts:
            said = " or ".join(str(len(names)) for names in _layouts(wanted, feed))
            raise ValueError(f"it has {len(header)} columns, its contract names {said}")
        names = layouts[len(header)]
        return [[names.index(n)] if n in names else [] for n in wanted]

    def by_expected(header: list[str]) -> list[list[int]]:
        have = [Hd.normalize_header(h, feed.headers) for h in header]
        lost = [h for h in feed.expected if h not in have and h not in feed.optional and h not in feed.dropped]
        unknown = [h for h in have if h not in feed.expected]
        if lost or unknown:
            raise ValueError(f"it lacks {lost} and has unknown {unknown}")
        return [[i for i, h in enumerate(have) if h == e] for e in feed.expected if e not in feed.dropped]

    def by_vocabulary(header: list[str]) -> list[list[int]]:
        if feed.first_header and header:
            header = [feed.first_header, *header[1:]]
        rank = {word: i for i, word in enumerate(feed.vocabulary)}
        names = [feed.vocabulary.get(h) or Hd.normalize_header(h, feed.headers) for h in header]
        names = [feed.renames.get(n, n) for n in names]
        lost = [k for k in keys if k not in names]
        if lost:
            raise ValueError(f"it lacks {lost}, by which its rows are merged")
        places = {n: [i for i, name in enumerate(names) if name == n] for n in wanted}
        return [sorted(places[n], key=lambda i: (rank.get(header[i], len(rank)), i)) for n in wanted]

    resolve = by_vocabulary if not feed.positional else by_expected if feed.expected else by_place
    columns = wanted[: len(feed.expected) - len(feed.dropped)] if feed.positional and feed.expected else wanted
    period = (feed.period_sheet, *feed.period[:2]) if feed.period else None
    return W.SheetRule(feed.sheet, feed.header_row, tuple(columns), resolve, period)


def grid_of(spark: SparkSession, feed: Feed, paths: list[str] | str) -> DataFrame:
    """The cells of all files: (path, sheet, row_no, cells)."""
    if feed.reader == "csv":
        return R.read_grid(spark, paths, blank_lines=False)
    if feed.reader == "csv_preamble":
        return R.read_preamble_grid(spark, paths)
    return read_workbook_grid(spark, paths, feed.sheet)


def shape_grid(grid: DataFrame, feed: Feed, schema: T.StructType, **tags: object) -> DataFrame:
    """Contract rows of a grid; ``tags`` add store, folder or load time."""
    if feed.period_sheet is not None or feed.first_header is not None:
        raise ValueError("the feed needs whole workbooks: use rows or shape_books")
    wanted = _own_columns(feed, schema, tags)
    head, data = feed.header_row, feed.header_row + 1
    if feed.positional and not feed.expected:
        body = R.table_by_place(grid, head, data, _layouts(wanted, feed))
    elif feed.positional:
        body = _by_expected(grid, feed, wanted)
    else:
        body = _by_vocabulary(grid, feed, wanted, [k for k in feed.keys if k in wanted])
    if feed.period:
        row, col, *_ = feed.period
        body = with_period(body, R.preamble_value(grid, row, col, "period"), feed)
    else:
        body = body.drop("path")
    return _typed_rows(C.tag(_lines(body, feed), **tags), feed, schema)


def _layouts(wanted: list[str], feed: Feed) -> list[list[str]]:
    """The columns a positional report may have: all, or all that are not derived."""
    own = [n for n in wanted if n not in feed.sums and n not in feed.remainders]
    return [wanted] if own == wanted else [wanted, own]


def _by_expected(grid: DataFrame, feed: Feed, wanted: list[str]) -> DataFrame:
    named = dict(zip([h for h in feed.expected if h not in feed.dropped], wanted))
    target = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    needed = F.array(*[F.lit(n) for h, n in named.items() if h not in feed.optional])
    dropped = F.array(*[F.lit(f"?{h}") for h in feed.dropped]).cast("array<string>")

    def name_of(header: Column) -> Column:
        plain = Hd.header_expression(header, feed.headers)
        return F.coalesce(F.try_element_at(target, plain), F.concat(F.lit("?"), plain))

    def refuse(names: Column) -> Column:
        unknown = F.array_except(F.filter(names, lambda n: n.startswith("?")), dropped)
        lost = F.array_except(needed, names)
        said = F.concat(F.lit("it lacks "), F.to_json(lost), F.lit(" and has unknown "), F.to_json(unknown))
        return F.when(F.size(lost) + F.size(unknown) > 0, said)

    return R.table_by_header(grid, feed.header_row, feed.header_row + 1, wanted, name_of, refuse=refuse)


def _by_vocabulary(grid: DataFrame, feed: Feed, wanted: list[str], keys: list[str]) -> DataFrame:
    pairs = lambda items: F.create_map(*[F.lit(x) for pair in items for x in pair])

    def name_of(header: Column) -> Column:
        name = Hd.header_expression(header, feed.headers)
        if feed.vocabulary:
            name = F.coalesce(F.try_element_at(pairs(feed.vocabulary.items()), header), name)
        return F.coalesce(F.try_element_at(pairs(feed.renames.items()), name), name) if feed.renames else name

    rank_of = None
    if feed.vocabulary:
        ranks = pairs((word, i) for i, word in enumerate(feed.vocabulary))
        rank_of = lambda header: F.try_element_at(ranks, header)

    def refuse(names: Column) -> Column:
        lost = F.array_except(F.array(*[F.lit(k) for k in keys]), names)
        return F.when(F.size(lost) > 0, F.concat(F.lit("it lacks "), F.to_json(lost), F.lit(", by which its rows are merged")))

    return R.table_by_header(
        grid, feed.header_row, feed.header_row + 1, wanted, name_of, rank_of, refuse if keys else None
    )


def _lines(df: DataFrame, feed: Feed) -> DataFrame:
    """Texts whose line breaks become blanks."""
    lines = {n: X.one_line(F.col(n)) for n in feed.one_line if n in df.columns}
    lines |= {n: X.drop_second_line_words(F.col(n)) for n in feed.first_line if n in df.columns}
    return df.withColumns(lines) if lines else df


def read(spark: SparkSession, feed: Feed, paths: list[str] | str) -> DataFrame:
    """Raw report rows: text columns under their printed headers, with file path."""
    if feed.period_sheet is not None or feed.first_header is not None:
        raise ValueError("the feed needs whole workbooks: use rows or shape_books")
    if feed.reader == "csv":
        return R.read_report_csv(spark, paths)
    if feed.reader == "csv_preamble":
        grid = R.read_preamble_grid(spark, paths)
    else:
        grid = read_workbook_grid(spark, paths, feed.sheet)
    return table_of(grid, feed)


def table_of(grid: DataFrame, feed: Feed) -> DataFrame:
    """Body of a report grid under its header row, dated by its period cell."""
    names = R.grid_header(grid, feed.header_row)
    while names and not names[-1]:
        names.pop()
    body = R.grid_to_table(grid, names, feed.header_row + 1)
    if feed.period:
        row, col, *_ = feed.period
        return with_period(body, R.preamble_value(grid, row, col, "period"), feed)
    return body.drop("path")


def clean(df: DataFrame, feed: Feed, schema: T.StructType, tags: tuple[str, ...] = ()) -> DataFrame:
    """Columns under contract names; values stay text until the contract applies. ``tags`` come with no report."""
    if feed.dropped and not feed.expected:
        raise ValueError("give the report's headers: dataclasses.replace(feed, expected=...)")
    dated = [c for c in ("start_date", "end_date") if c in df.columns and feed.period]
    if feed.positional:
        body = df.drop(*dated)
        if feed.expected:
            df = _in_order(Hd.normalize_headers(df, feed.headers), feed, dated)
            body = df.drop(*dated)
        layouts = _layouts([n for n in schema.fieldNames() if n not in dated and n not in tags], feed)
        fitting = [names for names in layouts if len(names) == len(body.columns)]
        if not fitting:
            raise ValueError(f"the report has {len(body.columns)} columns, its contract names {len(layouts[0])}")
        names = fitting[0]
        named = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(body.columns, names)], *dated)
    else:
        named = Hd.rename_synonyms(df, feed.vocabulary, style=feed.headers)
    named = named.withColumnsRenamed(feed.renames)
    named = _lines(named, feed)
    return named if feed.positional else C.add_if_missing(named, {n: "string" for n in feed.optional})


def _in_order(df: DataFrame, feed: Feed, dated: list[str]) -> DataFrame:
    """The columns a positional report is expected to have, in that order, without the dropped ones."""
    have = [c for c in df.columns if c not in dated]
    lost = [c for c in feed.expected if c not in have and c not in feed.optional]
    surplus = [c for c in have if c not in feed.expected]
    if lost or surplus:
        raise ValueError(f"the report lacks {lost} and has unknown {surplus}")
    wanted = [c for c in feed.expected if c not in feed.dropped]
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in wanted], *dated)


def _typed(name: str, have: T.DataType | None, want: T.DataType, feed: Feed) -> Column:
    if have is None or name in feed.always_null:
        return F.lit(None).cast(want)
    if not isinstance(have, T.StringType):
        return F.col(name).cast(want)
    value = X.nullify(X.strip_tabs(F.col(name)), feed.sentinels)
    numeric = isinstance(want, (T.LongType, T.DoubleType))
    word = {T.LongType: "INTEGER", T.DoubleType: "FLOAT"}.get(type(want))
    if name in feed.money or word in feed.money_types:
        number = X.parse_money(value)
    elif name in feed.percent:
        number = X.parse_percent(value)
    elif isinstance(want, T.LongType):
        number = X.int_from_float_text(value)
    elif isinstance(want, T.DoubleType):
        number = X.to_number(value)
    elif isinstance(want, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        formats = feed.date_formats or _ISO
        return D.parse_dates(value, *formats).cast(want)
    elif isinstance(want, T.BooleanType):
        return C.parse_boolean(value)
    else:
        return value if feed.invalid == "null" else F.col(name)
    if numeric and feed.invalid == "zero":
        return F.coalesce(number, F.lit(0)).cast(want)
    return number.cast(want)


#: Mark of a contract column that the report does not have.
ABSENT = {"absent": True}


def shape(df: DataFrame, feed: Feed, schema: T.StructType, **tags: object) -> DataFrame:
    """Raw report rows to contract rows; ``tags`` add store, folder or load time."""
    named = C.tag(clean(df, feed, schema, tuple(tags)), **tags)
    own = [k for k in feed.keys if k not in tags]
    if own and not any(k in named.columns for k in own):  # all rows would be merged into one
        raise ValueError(f"the report has none of {own}, by which its rows are merged")
    return _typed_rows(named, feed, schema)


def _typed_rows(named: DataFrame, feed: Feed, schema: T.StructType) -> DataFrame:
    have = {f.name: f.dataType for f in named.schema.fields}
    typed = named.select(
        *[
            _typed(f.name, have.get(f.name), f.dataType, feed).alias(f.name, metadata={} if f.name in have else ABSENT)
            for f in schema.fields
        ]
    )
    kinds = {f.name: f.dataType for f in schema.fields}
    derived = {n: N.total(*[F.col(p) for p in parts]).cast(kinds[n]) for n, parts in feed.sums.items()}
    derived |= {n: N.remainder(*[F.col(p) for p in parts]).cast(kinds[n]) for n, parts in feed.remainders.items()}
    return typed.withColumns(derived) if derived else typed


def with_period(df: DataFrame, cells: DataFrame, feed: Feed) -> DataFrame:
    """Start and end date from the file's period cell; ``cells`` is (path, period)."""
    return _dated(df.join(cells, "path", "left"), feed).drop("path")


def _dated(df: DataFrame, feed: Feed) -> DataFrame:
    """Start and end date in place of the text ``period``."""
    _, _, fmt, sep, prefix = feed.period
    if fmt == "id":
        parts = F.split("period", f"\\Q{sep}\\E")
        start, end = (D.parse_id_date(F.try_element_at(parts, F.lit(i))) for i in (1, -1))
    else:
        start, end = D.split_date_range(F.col("period"), fmt, sep, prefix)
    return df.withColumns({"start_date": start, "end_date": end}).drop("period")


def load(
    spark: SparkSession, rows: DataFrame, feed: Feed, path: str, staging: str, update_columns: list[str] | None = None
) -> None:
    """Contract rows into the table in the feed's way; refused if the report had not every key they are merged by."""
    lost = [k for k in feed.keys if k not in rows.columns or rows.schema[k].metadata.get("absent")]
    if lost:
        raise ValueError(f"the report has no {lost}, by which its rows are merged")
    if feed.load == "append":
        if feed.partition:
            K.append_partitioned(rows, path, *feed.partition)
        else:
            K.append(rows, path)
        return
    if feed.partition:
        moment, grain = feed.partition
        rows = rows.withColumn("part", K.partition_value(F.col(moment), grain))
    K.merge_into(
        spark, rows, path, list(feed.keys), staging,
        partition="part" if feed.partition else None,
        null_safe=feed.load == "merge",
        update_columns=update_columns,
        dedupe_order=list(feed.order),
        keep=feed.keep,
    )
