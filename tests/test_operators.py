import random

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from bazaar.operators import contracts as C
from bazaar.operators import dedupe as Dd
from bazaar.operators import filters as Fl
from bazaar.operators import headers as Hd
from bazaar.operators import joins as Jn
from bazaar.operators import reshape as R
from bazaar.operators.upsert import DuplicateKeyError, upsert


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


# contracts

def test_contract_forms():
    listed = C.contract(
        [
            {"name": "a", "type": "INTEGER", "mode": "NULLABLE"},
            {"name": "b", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "c", "type": "DATETIME"}]},
            {"name": "d", "type": "TIME"},
        ]
    )
    assert listed.simpleString() == "struct<a:bigint,b:array<struct<c:timestamp_ntz>>,d:string>"
    assert C.contract({"a": "FLOAT", "b": "BOOLEAN"}).simpleString() == "struct<a:double,b:boolean>"
    with pytest.raises(C.ContractError):
        C.contract({"a": "GEOGRAPHY"})


def test_strict_cast_fails_on_a_bad_value(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    with pytest.raises(NumberFormatException):
        C.cast_strict(df, C.contract({"a": "INTEGER"})).collect()


def test_tolerant_cast(spark):
    df = spark.createDataFrame(
        [("1.0", "1", "TRUE", "2024-01-02", None), ("x", "y", "maybe", "never", "t")],
        "i string, f string, b string, d string, s string",
    )
    schema = C.contract({"i": "INTEGER", "f": "FLOAT", "b": "BOOLEAN", "d": "DATE", "s": "STRING"})
    good, bad = C.cast_null_on_error(df, schema).collect()
    assert (good.i, good.f, good.b, str(good.d), good.s) == (1, 1.0, True, "2024-01-02", None)
    assert tuple(bad) == (None, None, None, None, "t")


def test_conform_is_idempotent_and_ordered(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "b int, extra string, a double")
    schema = C.contract({"a": "STRING", "b": "INTEGER", "c": "DATE", "d": "STRING"})
    once = C.conform(df, schema, {"d": "toko"})
    assert once.schema == C.conform(once, schema).schema and once.columns == ["a", "b", "c", "d"]
    assert rows(once) == rows(C.conform(once, schema))


def test_validate_columns(spark):
    df = spark.createDataFrame([("1", "2")], "b string, a string")
    assert C.validate_columns(df, ["a", "b"]).columns == ["a", "b"]
    assert C.validate_columns(df, ["a", "opt", "b"], ["opt"]).first().opt is None
    with pytest.raises(C.ContractError):
        C.validate_columns(df, ["a", "c"])
    with pytest.raises(C.ContractError):
        C.validate_columns(df, ["a"])


def test_nullify_and_stringify(spark):
    df = spark.createDataFrame([("--", float("nan"), [1, 2])], "a string, b double, c array<int>")
    clean = C.nullify_columns(df).first()
    assert clean.a is None and clean.b is None
    assert C.stringify(df, ["c"]).first().c == "1,2"
    assert C.stringify(df, ["c"], list_sep=None).first().c == "[1,2]"


def test_zero_on_error(spark):
    df = spark.createDataFrame([("Rp1.000",), ("batal",), (None,), ("12",)], "a string")
    assert [r[0] for r in df.select(C.zero_on_error(F.col("a"), money=True)).collect()] == [1000.0, 0.0, 0.0, 12.0]


# headers

@pytest.mark.parametrize(
    "style,header,name",
    [
        ("plain", "Harga Satuan (IDR)", "harga_satuan_idr"),
        ("slash_or", "Iklan/Toko (x)", "iklan_atau_toko_x"),
        ("stream", "Rata-rata Durasi (+ Rp)", "rata_rata_durasi__rp"),
        ("percent_word", "% Klik-an", "persentase__klik_an"),
        ("seo", "Hasil - Pencarian (SEO)", "hasil_pencarian"),
        ("collapse", "V-to-L  clicks", "vtol_clicks"),
        ("collapse", "Revenue (Rp)", "revenue"),
        ("metric", "Avg. Viewing Duration (Rp)", "avg_viewing_duration"),
        ("words", "Cancelation/Return Type", "cancelation_return_type"),
        ("words", "Phone #", "phone"),
        ("words", "Weight(kg)", "weight_kg"),
        ("camel", "orderItemId", "order_item_id"),
    ],
)
def test_header_styles_agree_on_both_sides(spark, style, header, name):
    assert Hd.normalize_header(header, style) == name
    df = spark.createDataFrame([(header,)], "h string")
    assert df.select(Hd.header_expression(F.col("h"), style)).first()[0] == name


def test_header_collision_is_refused(spark):
    with pytest.raises(C.ContractError):
        Hd.normalize_headers(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_synonyms_take_the_first_present_value(spark):
    df = spark.createDataFrame([(None, "y", 1), ("x", "z", 2)], "`Pusat ` string, Tab string, other int")
    out = Hd.rename_synonyms(df, {"Pusat": "revenue", "Tab": "revenue"})
    assert rows(out) == rows(spark.createDataFrame([("y", 1), ("x", 2)], "revenue string, other int"))


def test_positional_names_need_the_right_count(spark):
    with pytest.raises(C.ContractError):
        Hd.rename_positional(spark.range(1), ["a", "b"])


# filters

def test_day_range_is_inclusive(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 00:00:00'), (TIMESTAMP_NTZ'2024-01-02 23:59:59.999'), "
        "(TIMESTAMP_NTZ'2024-01-03 00:00:00'), (TIMESTAMP_NTZ'2023-12-31 23:59:59') AS t(m)"
    )
    assert df.filter(Fl.day_range(F.col("m"), "2024-01-01", "2024-01-02")).count() == 2


def test_squeezed_containment_is_literal(spark):
    df = spark.createDataFrame([("Toko A.B",), ("Toko AxB",)], "n string")
    assert df.filter(Fl.contains_squeezed(F.col("n"), "a A.B")).count() == 0
    assert df.filter(Fl.contains_squeezed(F.col("n"), "o A.B")).count() == 1


def test_arrival_gate(spark):
    assert Fl.has_more_than(spark.range(6), 5) and not Fl.has_more_than(spark.range(5), 5)


def test_hash_sample_does_not_depend_on_layout(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = (rows(Fl.hash_sample(x, "k", 3, 10, 100)) for x in (df, df.repartition(7)))
    assert a == b and 50 < len(a) < 200
    assert Fl.random_sample(df, 0.5, 10, seed=1).count() == 10


# dedupe

def test_dedupe_keeps_one_whole_row(spark):
    data = [(k, t, f"{k}-{t}") for k in (1, 2, None) for t in (3, 1, 2, None)]
    df = spark.createDataFrame(data, "k int, t int, v string")
    assert all(r.v == f"{r.k}-{r.t}" for r in Dd.dedupe(df, ["k"], ["t"]).collect())
    latest = {r.k: r.t for r in Dd.dedupe(df, ["k"], ["t"], "latest").collect()}
    oldest = {r.k: r.t for r in Dd.dedupe(df, ["k"], ["t"], "oldest").collect()}
    assert latest == {1: 3, 2: 3, None: 3} and oldest == {1: None, 2: None, None: None}
    again = Dd.dedupe(df, ["k"], ["t"])
    assert rows(Dd.dedupe(again, ["k"], ["t"])) == rows(again)


def test_top_n_equals_plain_ranking_with_a_hot_group(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(20)}", rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v int, id int").repartition(9)
    top = Dd.top_n_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 12, salts=4)
    want = []
    for g in {d[0] for d in data}:
        want += sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2]))[:12]
    assert rows(top) == sorted(map(repr, want))


def test_ranking_limits_rows_before_the_shuffle(spark, sf):
    plan = Dd.dedupe(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey"], ["l_partkey"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


# joins

def test_left_join_keeps_unmatched_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, r string")
    want = [(1, "a", "x"), (1, "a", "y"), (2, "b", None), (None, "c", None)]
    for hot_right in (False, True):
        got = Jn.left_join_fanout(left, right, ["k"], hot_right)
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    with pytest.raises(ValueError, match="rename"):
        Jn.left_join_fanout(left, right.withColumnRenamed("r", "l"), ["k"])


def test_flag_never_repeats_rows(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(Jn.flag_match(left, right, ["k"], "f")) == rows(
        spark.createDataFrame([(1, 1), (2, 0), (None, 0)], "k int, f int")
    )


def test_lookup_first_and_work_plan(spark):
    table = spark.createDataFrame([(1, "b", 2), (1, "a", 1)], "k int, v string, at int")
    assert Jn.lookup_first(spark.createDataFrame([(1,), (3,)], "k int"), table, "k", "at").orderBy("k").collect()[0].v == "a"
    seed = spark.createDataFrame([("x",), ("y",)], "c string")
    plan = Jn.work_plan(seed, 1, 3, ["c", "page"])
    assert plan.count() == 6
    assert rows(plan) == rows(Jn.work_plan(seed.repartition(3), 1, 3, ["c", "page"]))
    assert Jn.work_plan(seed, 3, 1, ["c"]).count() == 0


# reshape

def test_health_layout_positions():
    layout = R.health_layout()
    assert layout["pelanggaran_produk_ringan"] == 36 and layout["masa_pengemasan"] == 67
    assert layout["kecepatan_chat_dibalas"] == 83 and len(layout) == 15


def test_pivot_ignores_unknown_identifiers(spark):
    df = spark.createDataFrame(
        [("s", "finish_rate", 0.5), ("s", "penalty", 2.9), ("s", "unknown", 9.0), ("s", "cnt_unique_buyer", 4.0)],
        "shop string, id string, v double",
    )
    row = R.pivot_metrics(
        df, ["shop"], "id", "v", ["finish_rate", "penalty", "cnt_unique_buyer"],
        {"cnt_unique_buyer": "count_unique_buyer"}, {"finish_rate": 100.0}, ["penalty", "cnt_unique_buyer"],
    ).first()
    assert tuple(row) == ("s", 50.0, 2, 4)


# upsert

def plain_upsert(target, source, null_safe, changed):
    def same(a, b):
        return a == b and (null_safe or None not in a)

    out = []
    for t in target:
        hit = next((s for s in source if same(t[:2], s[:2])), None)
        out.append(tuple((hit[i] if i in changed else t[i]) for i in range(4)) if hit else t)
    out += [s for s in source if not any(same(t[:2], s[:2]) for t in target)]
    return sorted(map(repr, out))


SCHEMA = "a int, b string, v int, w string"


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("changed", [None, ["v"]])
@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_against_brute_force(spark, null_safe, changed, seed):
    rng = random.Random(seed)

    def key():
        return rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "x", "y", "NULL"])

    target = [(*key(), i, f"t{i}") for i in range(60)]
    source = [(*k, i, f"s{i}") for i, k in enumerate({key() for _ in range(12)})]
    got = upsert(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), ["a", "b"],
        null_safe=null_safe, update_columns=changed,
    )
    index = set(range(4)) if changed is None else {2}
    assert rows(got) == plain_upsert(target, source, null_safe, index)


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "x", 1, "t"), (None, "y", 2, "t")], SCHEMA)
    source = spark.createDataFrame([(None, "y", 3, "s"), (5, None, 4, "s")], SCHEMA)
    once = upsert(target, source, ["a", "b"])
    assert rows(upsert(once, source, ["a", "b"])) == rows(once)


def test_upsert_matches_keys_of_differing_types(spark):
    target = spark.createDataFrame([("1", 1), ("2", 2)], "k string, v int")
    source = spark.createDataFrame([(1, 10), (3, 30)], "k int, v int")
    assert rows(upsert(target, source, ["k"])) == rows(
        spark.createDataFrame([("1", 10), ("2", 2), ("3", 30)], "k string, v int")
    )


def test_repeated_source_keys_need_an_order(spark):
    target = spark.createDataFrame([(1, "x", 1, "t")], SCHEMA)
    source = spark.createDataFrame([(1, "x", 2, "s"), (1, "x", 3, "s")], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        upsert(target, source, ["a", "b"])
    assert upsert(target, source, ["a", "b"], dedupe_order=["v"]).first().v == 3
    assert upsert(target, source, ["a", "b"], dedupe_order=["v"], keep="oldest").first().v == 2


def test_empty_sides(spark):
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(None, "x", 1, "t")], SCHEMA)
    assert rows(upsert(empty, some, ["a", "b"])) == rows(some)
    assert rows(upsert(some, empty, ["a", "b"])) == rows(some)


@pytest.mark.parametrize("null_safe", [True, False])
def test_a_hot_target_key_is_split(spark, null_safe):
    """A third of the target under one key: AQE splits it instead of one long task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        target = spark.range(0, 300000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7 if not null_safe else None).otherwise(F.col("id")).alias("k"),
            F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        source = spark.range(0, 3000).select(
            F.when(F.col("id") == 0, 7 if not null_safe else None).otherwise(F.col("id") + 299000).alias("k"),
            (F.col("id") + 10**6).alias("v"), F.lit("s").alias("pad"),
        )
        merged = upsert(target, source, ["k"], null_safe=null_safe, dedupe_order=["v"])
        counted = merged.groupBy("pad").count().filter("pad = 's'")
        assert counted.first()["count"] > 100000
        merged.write.format("noop").mode("overwrite").save()
        merged.collect()
        assert "skew=true" in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("null_safe", [True, False])
def test_upsert_reads_each_side_little(spark, tmp_path, null_safe):
    """The source once, the target twice (its rows, its keys); five shuffles, one of them used twice."""
    target, source = str(tmp_path / "t"), str(tmp_path / "s")
    spark.createDataFrame([(1, "a", 1)], "k int, d string, v int").write.parquet(target)
    spark.createDataFrame([(1, "a", 2)], "k int, d string, v int").write.parquet(source)
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        for changed in (None, ["v"]):
            df = upsert(spark.read.parquet(target), spark.read.parquet(source), ["k", "d"], null_safe, changed, dedupe_order=["v"])
            text = df._jdf.queryExecution().executedPlan().toString()
            assert text.count("FileScan parquet") == 3 and text.count("SortMergeJoin") == 2
            assert text.count(f"paths)[file:{source}") == 1 and text.count(f"paths)[file:{target}") == 2
            assert text.count("ReusedExchange") == 1 and text.count("Exchange hashpartitioning") == 5 + 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sets_in_pages(spark):
    """An owner with many values: pages are full but for the last, and no task holds the set."""
    from bazaar.operators.reshape import paged_set

    big = spark.range(200_000).select(F.lit("o").alias("owner"), (F.col("id") % 100_003).cast("string").alias("tag"))
    small = spark.createDataFrame([("p", "x"), ("p", "x"), (None, "y"), ("q", None)], "owner string, tag string")
    pages = paged_set(big.union(small), "owner", "tag", 500)
    got = pages.groupBy("owner").agg(F.sum(F.size("values")).alias("n"), F.count("*").alias("pages"), F.max(F.size("values")).alias("most"))
    assert {(r.owner, r.n, r.pages, r.most) for r in got.collect()} == {("o", 100_003, 201, 500), ("p", 1, 1, 1), (None, 1, 1, 1)}
    assert pages.select(F.explode("values")).distinct().count() == 100_005
    sizes = pages.where("owner = 'o'").select("page", F.size("values").alias("n")).orderBy("page").collect()
    assert [r.page for r in sizes] == list(range(201)) and all(r.n == 500 for r in sizes[:-1])
