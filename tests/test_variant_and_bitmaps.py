"""Undeclared payloads by VARIANT, and coverage from bitmaps of increments."""

from pyspark.sql import functions as F

from bazaar.functions import variant as V
from bazaar.plans import coverage_bitmaps as B
from tests.test_operators import rows


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, payload string").repartition(2)


def test_late_fields_become_columns(spark):
    df = docs(spark, '{"a": 1, "b": {"c d": "x"}}', "no json", None, "[1]", '{"a": 2.5, "b": {"c d": null, "e": true}, "late": {"f": [1, {"g": 2}]}}')
    flat = V.flatten_variant(df, "payload")
    assert sorted(flat.columns) == ["a", "b__c d", "b__e", "late__f", "n"]
    got = {r.n: r for r in flat.collect()}
    assert (got[0].a, got[0]["b__c d"], got[0].b__e, got[0].late__f) == (1.0, "x", None, None)
    assert (got[4].a, got[4]["b__c d"], got[4].b__e, got[4].late__f) == (2.5, None, True, '[1,{"g":2}]')
    assert all(tuple(got[i])[1:] == (None,) * 4 for i in (1, 2, 3))


def test_fields_of_several_types(spark):
    df = docs(spark, '{"k": 1}', '{"k": "one"}', '{"k": {"x": 1}}', '{"k": null}')
    assert {r.n: r.k for r in V.flatten_variant(df, "payload").collect()} == {0: "1", 1: "one", 2: '{"x":1}', 3: None}


def test_drift(spark):
    known = V.load_schema(docs(spark, '{"a": 1, "gone": "x"}'), "payload")
    found = V.load_schema(docs(spark, '{"a": "1", "new": {"b": true}}', '{"a": "2"}'), "payload")
    assert V.drift(known, found) == [("a", "bigint", "string"), ("gone", "string", None), ("new__b", None, "boolean")]
    assert V.flatten_variant(docs(spark, '{"a": 5, "new": 1}'), "payload", known).columns == ["n", "a", "gone"]
    assert V.flatten_variant(docs(spark, "x"), "payload").columns == ["n"]


def test_increments_in_any_order(spark, tmp_path):
    """Counts equal those of all rows at once; a repeated load and repeated rows change nothing."""
    latest = spark.createDataFrame(
        [(n, "m" if n % 2 else "o", f"s{n % 3}", f"2024-01-{1 + n % 4:02d}") for n in [*range(-5, 200), 40_000, 70_000]],
        "customer_ref bigint, marketplace string, official_store string, order_date string",
    )
    collected = latest.where("customer_ref % 7 <> 0").select("customer_ref", "marketplace")
    collected = collected.union(collected).union(spark.createDataFrame([(40_000, "m"), (999_999, "o")], collected.schema))
    path = str(tmp_path / "c")
    for load in (2, 0, 1, 0):
        B.add_increment(latest.where(F.substring("order_date", -1, 1).cast("int") % 3 == load), collected.where(F.pmod("customer_ref", F.lit(3)) == load), path, str(load))
    flagged = latest.join(collected.distinct().withColumn("hit", F.lit(1)), ["customer_ref", "marketplace"], "left")
    want = flagged.groupBy("marketplace", "official_store", "order_date").agg(F.count("*").alias("n"), F.count("hit").alias("f"))
    got = B.read_coverage(spark, path).select("marketplace", "official_store", "order_date", "total_internal_order", "count_order_type")
    assert rows(got) == rows(want)
    assert all("/load=" in f for f in got.inputFiles())


def test_bitmaps_of_orders_far_apart_stay_small(spark, tmp_path):
    """Each order has a bitmap of its own here, which is no larger than the order."""
    latest = spark.range(0, 4_000_000_000, 100_000_000).selectExpr(
        "id - 2000000000 AS customer_ref", "'m' AS marketplace", "'s' AS official_store", "cast(id % 3 AS string) AS order_date"
    )
    path = str(tmp_path / "c")
    B.add_increment(latest, latest.where("customer_ref > 0"), path, "0")
    for side in ("known", "collected"):
        stored = spark.read.parquet(f"{path}/{side}")
        assert stored.agg(F.max(F.length(F.to_json(F.struct(side))))).first()[0] < 100
    total = B.read_coverage(spark, path).agg(F.sum("total_internal_order"), F.sum("count_order_type")).first()
    assert tuple(total) == (40, 19)
