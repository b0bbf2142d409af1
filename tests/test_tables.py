import os
import random

import pytest
from pyspark.sql import functions as F

from bazaar.operators.contracts import contract
from bazaar.sinks import tables as K
from tests.test_operators import rows


def test_first_load_then_merge_then_nothing(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "stage")
    first = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert K.merge_into(spark, first, path, ["k"], f"{staging}1", dedupe_order=["v"])
    assert rows(spark.read.parquet(path)) == rows(spark.createDataFrame([(1, "b"), (None, "c")], "k int, v string"))
    second = spark.createDataFrame([(None, "d"), (2, "e")], "k int, v string")
    assert K.merge_into(spark, second, path, ["k"], f"{staging}2")
    want = rows(spark.createDataFrame([(1, "b"), (None, "d"), (2, "e")], "k int, v string"))
    assert rows(spark.read.parquet(path)) == want
    assert not K.merge_into(spark, second.withColumn("v", F.lit("z")), path, ["k"], f"{staging}2")
    assert rows(spark.read.parquet(path)) == want


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    rng = random.Random(2)
    target = [(i, rng.choice("abcd"), 0) for i in range(40)]
    spark.createDataFrame(target, "k int, p string, v int").write.partitionBy("p").parquet(path)
    stamp = {p: sorted(os.listdir(f"{path}/p={p}")) for p in "abcd"}
    moved = [(k, "b", 1) for k, p, _ in target if p == "a"] + [(100, "e", 1), (101, None, 1)]
    source = spark.createDataFrame(moved, "k int, p string, v int")
    K.merge_into(spark, source, path, ["k"], str(tmp_path / "s"), partition="p")
    got = spark.read.schema("k int, v int, p string").parquet(path).select("k", "p", "v")
    want = [(k, p, v) for k, p, v in target if p != "a"] + moved
    assert rows(got) == sorted(map(repr, want))
    assert not os.path.exists(f"{path}/p=a")
    assert sorted(os.listdir(f"{path}/p=c")) == stamp["c"] and sorted(os.listdir(f"{path}/p=d")) == stamp["d"]


def test_a_failed_publish_goes_on_from_the_staged_rows(spark, tmp_path, monkeypatch):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(path)
    source = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")

    def broken(*_):
        raise OSError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(K, "_publish", broken)
        with pytest.raises(OSError):
            K.merge_into(spark, source, path, ["k"], staging)
    assert rows(spark.read.parquet(path)) == rows(spark.createDataFrame([(1, "a")], "k int, v string"))
    assert K.merge_into(spark, source, path, ["k"], staging)
    assert rows(spark.read.parquet(path)) == rows(source)


def test_quarantine_loses_nothing(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (-1, None)], "a int, b string")
    good, bad = K.quarantine(df, {"no b": F.col("b").isNotNull(), "a not positive": F.col("a") > 0})
    assert rows(good) == rows(spark.createDataFrame([(1, "x")], "a int, b string"))
    assert {r.reject_reason for r in bad.collect()} == {"no b", "a not positive"}
    assert good.count() + bad.count() == df.count()
    report = K.load_report(good, bad).first()
    assert (report.loaded_rows, report.rejected_rows, report.loaded_columns) == (1, 2, 2)
    assert K.load_report(good.limit(0)).first().loaded_rows == 0


def test_insert_rules(spark):
    target = contract({"a": "INTEGER", "b": "STRING"})
    source = spark.createDataFrame([("7", 1)], "b string, a int")
    assert tuple(K.insert_star(source, target).first()) == (1, "7")
    with pytest.raises(ValueError):
        K.insert_star(source.drop("a"), target)
    assert tuple(K.insert_select(source, target, {"a": "b"}).first()) == (None, "1")


def test_partition_grains(spark, tmp_path):
    df = spark.sql("SELECT TIMESTAMP'2024-02-03 04:05:06' AS t, 1 AS v")
    for grain, value in (("DAY", "2024-02-03"), ("MONTH", "2024-02"), ("YEAR", "2024")):
        path = str(tmp_path / grain)
        K.append_partitioned(df, path, "t", grain)
        assert os.path.exists(f"{path}/part={value}")


def test_create_deduped_is_day_partitioned(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-02', 'new'), (1, DATE'2024-01-01', 'old') AS t(k, d, v)")
    K.create_deduped(df, str(tmp_path / "t"), ["k"], ["d"], "d")
    row = spark.read.parquet(str(tmp_path / "t")).first()
    assert row.v == "old" and str(row.part) == "2024-01-01"


def test_partition_texts_that_look_like_numbers_or_need_escapes(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(1, "007", 0), (2, "x:y", 0), (3, None, 0), (4, "a b/c", 0), (5, "7", 0)]
    spark.createDataFrame(first, "k int, p string, v int").write.partitionBy("p").parquet(path)
    source = [(1, "007", 1), (2, "7", 1), (3, "x:z", 1), (4, "x:y", 1)]
    K.merge_into(
        spark, spark.createDataFrame(source, "k int, p string, v int"), path, ["k"], str(tmp_path / "s"), partition="p"
    )
    got = spark.read.schema("k int, v int, p string").parquet(path).select("k", "p", "v")
    assert rows(got) == sorted(map(repr, [*source, (5, "7", 0)]))
    assert sorted(os.listdir(tmp_path / "s")) == ["published"]


def test_partition_in_the_key_and_many_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    target = [(i, f"p{i % 6}", 0) for i in range(30)]
    spark.createDataFrame(target, "k int, p string, v int").write.partitionBy("p").parquet(path)
    source = [(0, "p0", 1), (1, "p1", 1), (1, "p2", 1), (99, None, 1)]
    K.merge_into(
        spark, spark.createDataFrame(source, "k int, p string, v int"), path, ["k", "p"], str(tmp_path / "s"), partition="p"
    )
    got = spark.read.schema("k int, v int, p string").parquet(path).select("k", "p", "v")
    want = {(k, p): v for k, p, v in target} | {(k, p): v for k, p, v in source}
    assert rows(got) == sorted(repr((k, p, v)) for (k, p), v in want.items())
