"""Joins and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import LINE_KEY, LINE_ORDER, check, table
from bazaar.functions import nested as J
from bazaar.operators import joins as Jn
from bazaar.operators.upsert import upsert
from bazaar.session import work_folder
from bazaar.sinks import tables as K
from bazaar.sources import files


@check(
    "left_join_fanout",
    """
SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""",
)
def left_join_fanout(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    return Jn.left_join_fanout(orders, lines, ["o_orderkey"])


@check(
    "left_join_flag",
    """
SELECT o_orderkey, o_orderstatus, CAST(CASE WHEN l_orderkey IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS found
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_linestatus FROM lineitem)
  ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus
""",
)
def left_join_flag(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus")
    )
    return Jn.flag_match(orders, lines, ["o_orderkey", "o_orderstatus"], "found")


def keyed_lines(spark, d):
    """Line items whose line number is missing on returned lines: a hot NULL key part."""
    return table(spark, d, "lineitem").withColumn(
        "l_linenumber", F.when(F.col("l_returnflag") != "R", F.col("l_linenumber"))
    )


def line_source(spark, d):
    """A later load: shipped a week on, half of its orders unknown to the target."""
    return keyed_lines(spark, d).withColumns(
        {
            "l_orderkey": F.col("l_orderkey") + F.when(F.col("l_linestatus") == "O", 0).otherwise(1000000),
            "l_quantity": F.col("l_quantity") + 100,
        }
    )


_TARGET = """
target AS (
  SELECT l_orderkey, CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS l_linenumber, l_partkey, l_quantity,
    l_returnflag, l_shipdate FROM lineitem
), source AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, l_shipdate FROM (
    SELECT l_orderkey + CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1000000 END AS l_orderkey,
      CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS l_linenumber, l_quantity + 100 AS l_quantity,
      l_partkey, l_returnflag, l_shipdate, l_suppkey, l_extendedprice, l_discount, l_tax, l_linestatus FROM lineitem
  ) {dedupe}
)
"""
_DEDUPE = """
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
    l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
    l_linestatus DESC) = 1
"""
_STRICT_DEDUPE = _DEDUPE.rstrip() + " OR l_linenumber IS NULL\n"
_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"]


def _merge_sql(null_safe: bool, changed: list[str]) -> str:
    match = "t.l_orderkey = s.l_orderkey AND t.l_linenumber {} s.l_linenumber".format(
        "IS NOT DISTINCT FROM" if null_safe else "="
    )
    kept = ", ".join(
        f"CASE WHEN s.l_orderkey IS NULL THEN t.{c} ELSE s.{c} END AS {c}" if c in changed else f"t.{c} AS {c}"
        for c in _OUT
    )
    return (
        "WITH"
        + _TARGET.format(dedupe=_DEDUPE if null_safe else _STRICT_DEDUPE)
        + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM (
  SELECT {kept} FROM target t LEFT JOIN source s ON {match}
  UNION ALL
  SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {match}))
"""
    )


def _shown(merged):
    return merged.select(*_OUT).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@check("upsert_nullsafe", _merge_sql(True, _OUT))
def upsert_nullsafe(spark, d):
    return _shown(upsert(keyed_lines(spark, d), line_source(spark, d), LINE_KEY, dedupe_order=LINE_ORDER))


@check("upsert_strict", _merge_sql(False, _OUT))
def upsert_strict(spark, d):
    return _shown(
        upsert(keyed_lines(spark, d), line_source(spark, d), LINE_KEY, null_safe=False, dedupe_order=LINE_ORDER)
    )


@check("upsert_partial", _merge_sql(True, ["l_quantity", "l_partkey"]))
def upsert_partial(spark, d):
    return _shown(
        upsert(
            keyed_lines(spark, d),
            line_source(spark, d),
            LINE_KEY,
            update_columns=["l_quantity", "l_partkey"],
            dedupe_order=LINE_ORDER,
        )
    )


@check(
    "merge_fragments",
    """
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value FROM events
""",
)
def merge_fragments(spark, d):
    """Two sibling fragments of one document become one row; nothing is joined."""
    doc = table(spark, d, "events").select(
        "event_id",
        F.struct(F.col("user_id").alias("user__Id")).alias("basicInfo"),
        F.array(
            F.struct(F.lit("media").alias("name"), F.lit(None).cast("struct<k:bigint,value:double>").alias("data")),
            F.struct(
                F.lit("product_content").alias("name"),
                F.struct(F.from_json("props", "k bigint").getField("k").alias("k"), F.col("value")).alias("data"),
            ),
        ).alias("components"),
    )
    content = J.find_element(F.col("components"), "name", "product_content").getField("data")
    merged = doc.select("event_id", F.struct(F.col("basicInfo"), content.alias("content")).alias("doc"))
    flat = J.flatten_json(merged, "doc", keep=("event_id",))
    return flat.select(
        "event_id",
        F.col("basicinfo__userid").alias("user_id"),
        F.col("content__k").alias("k"),
        F.col("content__value").alias("value"),
    )


@check(
    "lookup_first",
    """
SELECT c_custkey, n_name AS first_name FROM customer LEFT JOIN (
  SELECT n_regionkey, n_name FROM nation QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) = 1)
ON c_nationkey = n_regionkey
""",
)
def lookup_first(spark, d):
    nation = table(spark, d, "nation").select(
        F.col("n_regionkey").alias("key"), F.col("n_name").alias("first_name"), "n_nationkey"
    )
    customers = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("key"))
    return Jn.lookup_first(customers, nation, "key", "n_nationkey").drop("key")


@check(
    "seed_lookup",
    """
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey <> 0
""",
)
def seed_lookup(spark, d):
    """The seed comes from a CSV file; one of its rows has no key."""
    path = work_folder(spark, "seed")
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    K.export_csv(nation.union(nation.limit(1).select(F.lit(None), "n_name")), path)
    seed = files.load_seed(spark, path, "c_nationkey int, n_name string", "c_nationkey")
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return Jn.seed_lookup(customers, seed, "c_nationkey", skip=F.col("c_nationkey") == 0).drop("c_nationkey")


@check(
    "work_plan",
    """
SELECT p_partkey, page, strftime(day, '%Y-%m-%d') AS day FROM part,
  LATERAL (SELECT unnest(range(1, 1 + p_size)) AS page),
  LATERAL (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-03', INTERVAL 1 DAY)) AS day)
""",
)
def work_plan(spark, d):
    days = F.sequence(
        F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date"), F.expr("interval 1 day")
    )
    seed = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("bigint").alias("pages"))
    plan = Jn.work_plan(seed, F.lit(1).cast("bigint"), F.col("pages"), ["p_partkey", "page", "day"], days=days)
    return plan.orderBy("shuffle_order").select("p_partkey", "page", F.date_format("day", "yyyy-MM-dd").alias("day"))
