"""Contracts, casts, headers and column operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import check, day_text, table
from bazaar.functions import nested as J
from bazaar.functions import text as X
from bazaar.operators import contracts as C
from bazaar.operators import headers as Hd

PART_CONTRACT = [
    {"name": "p_name", "type": "STRING"},
    {"name": "p_partkey", "type": "INTEGER"},
    {"name": "size", "type": "FLOAT"},
    {"name": "seen", "type": "TIMESTAMP"},
    {"name": "store", "type": "STRING"},
    {"name": "tags", "type": "STRING", "mode": "REPEATED"},
    {"name": "detail", "type": "RECORD", "fields": [{"name": "a", "type": "INTEGER"}, {"name": "b", "type": "DATE"}]},
]


@check(
    "contract_schema",
    """
SELECT p_partkey, p_name, p_size AS size, CAST(p_size AS VARCHAR) AS first_tag, CAST(p_partkey AS BIGINT) AS a,
  'bigint,string,array<string>,struct<a:bigint,b:date>' AS kinds
FROM part
""",
)
def contract_schema(spark, d):
    schema = C.contract(
        [
            {"name": "p_partkey", "type": "INTEGER"},
            {"name": "p_name", "type": "STRING"},
            {"name": "tags", "type": "STRING", "mode": "REPEATED"},
            {"name": "detail", "type": "RECORD", "fields": PART_CONTRACT[-1]["fields"]},
        ]
    )
    raw = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        "p_name",
        "p_size",
        F.array("p_size").alias("tags"),
        F.struct(F.col("p_partkey").cast("string").alias("a"), F.lit("2024-01-01").alias("b")).alias("detail"),
    )
    typed = C.cast_null_on_error(raw, schema, extra=("p_size",))
    return typed.select(
        "p_partkey",
        "p_name",
        F.col("p_size").alias("size"),
        F.element_at("tags", 1).alias("first_tag"),
        F.col("detail.a").alias("a"),
        F.concat_ws(",", *[F.lit(f.dataType.simpleString()) for f in schema.fields]).alias("kinds"),
    )


@check(
    "cast_strict",
    """
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderkey % 2 = 0 AS even FROM orders
""",
)
def cast_strict(spark, d):
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        F.when(F.col("o_orderkey") % 2 == 0, "true").otherwise("0").alias("even"),
    )
    schema = C.contract({"o_orderkey": "INTEGER", "o_totalprice": "FLOAT", "o_orderdate": "TIMESTAMP", "even": "BOOLEAN"})
    return C.cast_strict(raw, schema).withColumn("o_orderdate", day_text(F.col("o_orderdate")))


@check(
    "cast_coerce_null",
    r"""
SELECT doc_id,
  CASE WHEN doc_id % 3 = 0 THEN n_chars END AS n_chars,
  CASE WHEN doc_id % 3 <> 1 THEN CAST(n_chars AS DOUBLE) END AS amount,
  CASE WHEN doc_id % 3 = 2 THEN '2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') END AS day,
  CASE doc_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS flag,
  CASE WHEN doc_id % 3 = 1 THEN text END AS text
FROM documents
""",
)
def cast_coerce_null(spark, d):
    kind = F.col("doc_id") % 3
    shown = F.col("n_chars").cast("string")
    raw = table(spark, d, "documents").select(
        "doc_id",
        F.when(kind == 0, shown).when(kind == 1, F.concat(shown, F.lit(" huruf"))).alias("n_chars"),
        F.when(kind == 1, "text").otherwise(shown).alias("amount"),
        F.when(kind == 2, F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")))
        .when(kind == 0, "2024-13-45")
        .otherwise("kemarin")
        .alias("day"),
        F.when(kind == 0, "TRUE").when(kind == 1, "0").otherwise("mungkin").alias("flag"),
        F.when(kind == 1, F.col("text")).alias("text"),
    )
    schema = C.contract(
        {"n_chars": "INTEGER", "amount": "FLOAT", "day": "DATE", "flag": "BOOLEAN", "text": "STRING"}
    )
    return C.cast_null_on_error(raw, schema, extra=("doc_id",)).withColumn("day", day_text(F.col("day")))


@check(
    "cast_coerce_zero",
    """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN 0 ELSE round(l_extendedprice, 2) END AS price,
  CASE WHEN l_returnflag = 'A' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS quantity
FROM lineitem
""",
)
def cast_coerce_zero(spark, d):
    from bazaar.checks.text import money_text

    money = F.concat(F.lit("Rp"), money_text(F.col("l_extendedprice")))
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        C.zero_on_error(F.when(F.col("l_returnflag") == "R", "batal").otherwise(money), money=True).alias("price"),
        C.zero_on_error(
            F.when(F.col("l_returnflag") != "A", F.col("l_quantity").cast("string")), target="bigint"
        ).alias("quantity"),
    )


@check(
    "conform",
    """
SELECT p_name, p_partkey, CAST(NULL AS DOUBLE) AS size, CAST(NULL AS VARCHAR) AS seen, 'toko' AS store,
  CAST(NULL AS VARCHAR) AS tags, CAST(NULL AS BIGINT) AS a FROM part
""",
)
def conform(spark, d):
    typed = C.conform(table(spark, d, "part"), C.contract(PART_CONTRACT), {"store": "toko"})
    again = C.conform(typed, C.contract(PART_CONTRACT))
    return again.select(
        "p_name", "p_partkey", "size", F.col("seen").cast("string").alias("seen"), "store",
        F.array_join("tags", ",").alias("tags"), F.col("detail.a").alias("a"),
    )


@check(
    "add_if_missing",
    """
SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS rating FROM supplier
""",
)
def add_if_missing(spark, d):
    wider = C.add_if_missing(table(spark, d, "supplier"), {"rating": "double", "s_name": "string"})
    return wider.select("s_suppkey", "s_name", "rating")


@check(
    "validate_columns",
    "SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS gudang_pengiriman, s_acctbal FROM supplier",
)
def validate_columns(spark, d):
    found = table(spark, d, "supplier").drop("s_nationkey")
    return C.validate_columns(
        found, ["s_suppkey", "s_name", "gudang_pengiriman", "s_acctbal"], ["gudang_pengiriman"]
    )


@check(
    "null_record",
    """
SELECT event_id, CASE WHEN event_type <> 'view' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  TRUE AS has_record FROM events
""",
)
def null_record(spark, d):
    schema = C.contract([{"name": "k", "type": "INTEGER"}, {"name": "label", "type": "STRING"}])
    parsed = F.when(F.col("event_type") != "view", F.from_json("props", schema))
    rows = table(spark, d, "events").select("event_id", J.fill_null_record(parsed, schema).alias("info"))
    return rows.select("event_id", F.col("info.k").alias("k"), F.col("info").isNotNull().alias("has_record"))


@check(
    "nullify",
    """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS price FROM orders
""",
)
def nullify(spark, d):
    words = F.array(*[F.lit(w) for w in ("", "--", "n/a", "nan")], F.col("o_orderstatus"))
    raw = table(spark, d, "orders").select(
        "o_orderkey",
        F.element_at(words, (F.col("o_orderkey") % 5 + 1).cast("int")).alias("status"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).otherwise(F.lit(float("nan"))).alias("price"),
    )
    return C.nullify_columns(raw)


@check(
    "rename_synonyms",
    """
SELECT c_custkey AS buyers, coalesce(CASE WHEN c_nationkey % 2 = 0 THEN c_name END, c_mktsegment)
  AS shopping_center_revenue, c_acctbal AS revenue, c_nationkey AS untouched FROM customer
""",
)
def rename_synonyms(spark, d):
    from bazaar.plans.vocabularies import OVERVIEW_V1_INDONESIAN

    raw = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Pembeli "),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name")).alias("Penghasilan dari Pusat Belanja"),
        F.col("c_mktsegment").alias("Penghasilan dari Shop Tab"),
        F.col("c_acctbal").alias("Revenue (Rp)"),
        F.col("c_nationkey").alias("untouched"),
    )
    return Hd.rename_synonyms(raw, OVERVIEW_V1_INDONESIAN, style="metric")


@check(
    "rename_positional",
    "SELECT n_nationkey AS kode, n_name AS nama, n_regionkey AS wilayah FROM nation",
)
def rename_positional(spark, d):
    return Hd.rename_positional(table(spark, d, "nation"), ["kode", "nama", "wilayah"])


STYLE_SQL = {
    "plain": "regexp_replace(replace(h, ' ', '_'), '[^_a-z0-9]', '', 'g')",
    "slash_or": "replace(replace(replace(replace(h, ' ', '_'), '/', '_atau_'), '(', ''), ')', '')",
    "brackets": "replace(replace(replace(h, ' ', '_'), '(', ''), ')', '')",
    "marks": "regexp_replace(replace(h, ' ', '_'), '[().,]', '', 'g')",
    "slash_marks": "regexp_replace(replace(h, ' ', '_'), '[()./]', '', 'g')",
    "slash_marks_dash": "replace(regexp_replace(replace(h, ' ', '_'), '[()./]', '', 'g'), '-', '_')",
    "stream": "replace(replace(replace(replace(replace(replace(h, ' ', '_'), '-', '_'), '(', ''), ')', ''), '+_', ''), 'rp', '_rp')",
    "percent_word": "replace(replace(replace(h, ' ', '_'), '%', 'persentase_'), '-', '_')",
    "seo": "replace(replace(replace(h, ' (seo)', ''), ' -', ''), ' ', '_')",
    "collapse": "replace(regexp_replace(replace(replace(h, ' (rp)', ''), ' ', '_'), '[^_a-z0-9]', '', 'g'), '__', '_')",
    "metric": "regexp_replace(regexp_replace(replace(h, ' (rp)', ''), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g')",
    "words": "regexp_replace(regexp_replace(h, '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g')",
}


@check(
    "normalize_headers",
    "SELECT p_partkey, "
    + ", ".join(f"{sql} AS {style}" for style, sql in STYLE_SQL.items())
    + r""", lower(regexp_replace(camel, '([a-z])([A-Z])', '\1_\2', 'g')) AS camel
FROM (SELECT p_partkey, lower(p_name || ' (SEO) - ' || p_type || '/% Nilai+ (Rp) ' || p_brand) AS h,
  replace(p_type, 'O', 'o') || p_brand || 'Id' AS camel FROM part)""",
)
def normalize_headers(spark, d):
    header = F.concat("p_name", F.lit(" (SEO) - "), "p_type", F.lit("/% Nilai+ (Rp) "), "p_brand")
    camel = F.concat(F.replace("p_type", F.lit("O"), F.lit("o")), "p_brand", F.lit("Id"))
    return table(spark, d, "part").select(
        "p_partkey",
        *[Hd.header_expression(header, style).alias(style) for style in STYLE_SQL],
        Hd.header_expression(camel, "camel").alias("camel"),
    )


@check("drop_columns", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def drop_columns(spark, d):
    return table(spark, d, "part").drop("p_name", "p_retailprice", "not_there")


@check("drop_array_columns", "SELECT vec_id, label FROM embeddings")
def drop_array_columns(spark, d):
    return C.drop_array_columns(table(spark, d, "embeddings"))


@check(
    "tag",
    "SELECT n_nationkey, n_name, 'toko' AS store_name, '2024-01-02 03:04:05' AS load_timestamp FROM nation",
)
def tag(spark, d):
    stamped = C.tag(
        table(spark, d, "nation").drop("n_regionkey"),
        store_name="toko",
        load_timestamp=F.lit("2024-01-02 03:04:05").cast("timestamp"),
    )
    return stamped.withColumn("load_timestamp", F.date_format("load_timestamp", "yyyy-MM-dd HH:mm:ss"))


@check(
    "stringify",
    """
SELECT vec_id, CAST(label AS VARCHAR) AS label, len(embedding) AS items,
  array_to_string(list_transform(embedding, lambda x: CAST(CAST(round(x * 1000) AS INTEGER) AS VARCHAR)), ',') AS joined
FROM embeddings
""",
)
def stringify(spark, d):
    whole = F.transform("embedding", lambda x: F.round(x * 1000).cast("int"))
    raw = table(spark, d, "embeddings").select(
        "vec_id", "label", F.size("embedding").cast("bigint").alias("items"), whole.alias("joined")
    )
    return C.stringify(raw, ["label", "joined"])


@check(
    "flatten_struct",
    """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, user_id AS owner_id, event_type AS kind FROM events
""",
)
def flatten_struct(spark, d):
    raw = table(spark, d, "events").select(
        "event_id",
        F.from_json("props", "k bigint").alias("props"),
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("owner"),
    )
    return J.flatten_struct_columns(raw, ["props", "owner"], {"owner.id": "owner_id"})


@check(
    "category_from_path",
    """
SELECT page_id, string_split(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '.')[1] AS from_dot,
  string_split(string_split(url, '/')[-1], '?')[1] AS from_file
FROM pages
""",
)
def category_from_path(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        X.segment(X.url_host(F.col("url")), 0, ".").alias("from_dot"),
        F.substring_index(X.segment(F.col("url"), -1), "?", 1).alias("from_file"),
    )
