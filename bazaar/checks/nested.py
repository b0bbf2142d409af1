"""Nested JSON operators. Arrays are built inside a row, never gathered from groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import check, table
from bazaar.functions import nested as J
from bazaar.functions import variant as V
from bazaar.sources.payloads import parse_payload

LINE_ITEMS = "regexp_split_to_array(text, '\\n')"


def line_payloads(spark, d):
    """Documents as catalogue payloads: one item per line of text, as JSON."""
    items = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.struct(
                i.alias("itemid"), F.length(line).alias("price"), line.alias("name"),
                F.split(line, " ").alias("options"),
            ).alias("item_basic")
        ),
    )
    payload = F.to_json(F.struct(items.alias("items"), F.col("lang").alias("language")))
    return table(spark, d, "documents").select("doc_id", payload.alias("payload"))


PAYLOAD_SCHEMA = (
    "items array<struct<item_basic: struct<itemid bigint, price bigint, name string, options array<string>, "
    "absent string>>>, language string"
)


@check(
    "flatten_json",
    """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props__k, event_type AS meta__kind,
  user_id AS meta__owner__id FROM events
""",
)
def flatten_json(spark, d):
    docs = table(spark, d, "events").select(
        "event_id",
        F.struct(
            F.from_json("props", "k bigint").alias("props"),
            F.struct(
                F.col("event_type").alias("Kind"), F.struct(F.col("user_id").alias("__id")).alias("owner")
            ).alias("meta"),
        ).alias("doc"),
    )
    return J.flatten_json(docs, "doc", keep=("event_id",))


@check(
    "explode_items",
    """
SELECT doc_id, i - 1 AS itemid, CAST(length(lines[i]) AS BIGINT) AS price, lines[i] AS name,
  CAST(NULL AS VARCHAR) AS absent
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
  LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)
""",
)
def explode_items(spark, d):
    docs = parse_payload(line_payloads(spark, d), "payload", PAYLOAD_SCHEMA)
    rows = J.explode_items(docs, F.col("doc.items"), ["doc_id"], inner="item_basic")
    return rows.drop("options")


@check(
    "explode_nested",
    """
SELECT doc_id, unnest(string_split(line, ' ')) AS username FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
""",
)
def explode_nested(spark, d):
    sections = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(F.transform(F.split(line, " "), lambda w: F.struct(w.alias("username"))).alias("medias")),
    )
    docs = table(spark, d, "documents").select("doc_id", sections.alias("sections"))
    return J.explode_nested(docs, F.col("sections"), "medias", ["doc_id"])


@check(
    "array_find",
    """
SELECT doc_id, list_filter(string_split(text, ' '), lambda w: length(w) = 7)[1] AS seven FROM documents
""",
)
def array_find(spark, d):
    words = F.transform(
        F.split("text", " "),
        lambda w: F.struct(F.when(F.length(w) == 7, "product_content").otherwise("other").alias("name"), w.alias("data")),
    )
    found = J.find_element(words, "name", "product_content")
    return table(spark, d, "documents").select("doc_id", found.getField("data").alias("seven"))


@check(
    "widget_lookup",
    r"""
SELECT conv_id, turn, i - 1 AS row_no, j - 1 AS col_no, cells[j] AS value FROM (
  SELECT conv_id, turn, i, string_split(lines[i], ' ') AS cells FROM (
    SELECT conv_id, turn, string_split(text, chr(10)) AS lines FROM conversations),
    LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)),
  LATERAL (SELECT unnest(range(1, len(cells) + 1)) AS j)
""",
)
def widget_lookup(spark, d):
    def cell(word):
        return F.struct(F.concat(F.lit("<b>"), word, F.lit("</b>")).alias("value"))

    rows = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.transform(F.split(line, " "), cell).alias("columns"))
    )
    blank = F.filter(rows, lambda r: F.lit(False))
    widgets = F.array(
        F.struct(F.lit("communicationSpeed").alias("data_key"), blank.alias("rows")),
        F.struct(F.lit("communicationRate").alias("data_key"), rows.alias("rows")),
    )
    talks = table(spark, d, "conversations").select("conv_id", "turn", widgets.alias("widgets"))
    cells = J.widget_cells(talks, F.col("widgets"), "communicationRate", ["conv_id", "turn"])
    return cells.withColumns({c: F.col(c).cast("bigint") for c in ("row_no", "col_no")})


@check(
    "optional_field",
    """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS delivery_service FROM events
""",
)
def optional_field(spark, d):
    parsed = parse_payload(table(spark, d, "events"), "props", "k bigint", "rating")
    return parsed.select(
        "event_id",
        J.optional_field(parsed, "rating", "k", "bigint").alias("k"),
        J.optional_field(parsed, "rating", "delivery_service", "string").alias("delivery_service"),
    )


@check(
    "json_default",
    """
SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, 'no links' AS external_url,
  'false' AS is_business_account FROM events
""",
)
def json_default(spark, d):
    props = F.col("props")
    return table(spark, d, "events").select(
        "event_id",
        J.json_default(props, "$.k", "0").alias("k"),
        J.json_default(props, "$.external_url", "no links").alias("external_url"),
        J.json_default(props, "$.is_business_account", "false").alias("is_business_account"),
    )


@check(
    "to_json_text",
    """
SELECT event_id, '{"user_id":' || CAST(user_id AS VARCHAR) || ',"kind":"' || event_type || '","tags":["' || event_type
  || '"]}' AS node_content FROM events
""",
)
def to_json_text(spark, d):
    node = F.struct("user_id", F.col("event_type").alias("kind"), F.array("event_type").alias("tags"))
    return table(spark, d, "events").select("event_id", F.to_json(node).alias("node_content"))


@check(
    "edge_list",
    """
SELECT CAST(conv_id AS VARCHAR) AS owner, turn AS post, unnest(list_filter(
  string_split(replace(text, chr(10), ' '), ' '), lambda w: length(w) > 8)) AS tagged FROM conversations
""",
)
def edge_list(spark, d):
    words = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    talks = table(spark, d, "conversations").withColumn("owner", F.col("conv_id").cast("string"))
    return J.edge_list(talks, "owner", "turn", F.filter(words, lambda w: F.length(w) > 8))


@check(
    "flatten_variant",
    """
SELECT o_orderkey AS id, o_totalprice AS info__total, o_orderstatus AS info__status,
  CASE WHEN o_orderkey % 997 = 0 THEN o_orderpriority END AS late, CASE WHEN o_orderkey % 2 = 0 THEN TRUE END AS even,
  '[' || o_custkey || ']' AS list, CASE WHEN o_orderkey % 3 = 0 THEN 'text' ELSE CAST(o_custkey AS VARCHAR) END AS either
FROM orders
""",
)
def flatten_variant(spark, d):
    """Documents of no declared schema; some fields are in few rows, one has two types."""
    key = F.col("o_orderkey")
    either = F.when(key % 3 == 0, F.lit('"text"')).otherwise(F.col("o_custkey").cast("string"))
    part = lambda name, value: F.concat(F.lit(f', "{name}": '), value)
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    body = F.concat(
        F.lit('{"id": '), key, F.lit(', "info": {"total": '), F.col("o_totalprice").cast("decimal(18,2)"), F.lit(', "status": '),
        text(F.col("o_orderstatus")), F.lit("}"), part("list", F.concat(F.lit("["), F.col("o_custkey"), F.lit("]"))), part("either", either),
        F.when(key % 997 == 0, part("late", text(F.col("o_orderpriority")))).otherwise(""),
        F.when(key % 2 == 0, part("even", F.lit("true"))).otherwise(""), F.lit("}"),
    )
    docs = table(spark, d, "orders").select(body.alias("payload"))
    return V.flatten_variant(docs, "payload")
