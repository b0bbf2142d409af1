"""Indexed tables: what a merge reads, writes and publishes."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from bazaar.operators.upsert import upsert
from bazaar.sinks import indexed as I
from bazaar.streaming.upserts import stream_upsert_indexed
from tests.test_operators import rows

SCHEMA = "k bigint, day string, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def live(spark, path):
    return {r.file for r in I._live(spark, path).collect()}


@pytest.fixture
def table(spark, tmp_path):
    """400 keys in about eight files."""
    path = str(tmp_path / "t")
    I.create_indexed(spark, frame(spark, *[(i, "a" if i % 2 else None, 0) for i in range(400)]), path, ["k", "day"], slot_rows=10, file_rows=50)
    return path


def test_one_row_rewrites_one_file(spark, table):
    before = live(spark, table)
    assert len(before) >= 6
    assert I.merge_indexed(spark, frame(spark, (7, "a", 1)), table, "one")
    gone, new = before - live(spark, table), live(spark, table) - before
    assert len(gone) == 1 and len(new) <= 2 and all(f.startswith("one/") for f in new)
    got = I.read_indexed(spark, table)
    assert got.count() == 400 and got.where("k = 7").first().v == 1


def test_new_keys_rewrite_no_file(spark, table):
    before = live(spark, table)
    assert I.merge_indexed(spark, frame(spark, *[(10_000 + i, "b", 1) for i in range(30)]), table, "new")
    assert before <= live(spark, table) and I.read_indexed(spark, table).count() == 430


@pytest.mark.parametrize("null_safe", [True, False])
def test_merges_as_upsert_does(spark, tmp_path, null_safe):
    draw = random.Random(int(null_safe))
    row = lambda v: (draw.choice([None, *range(60)]), draw.choice([None, "a", "b"]), v)
    path = str(tmp_path / "t")
    first = [*{(k, d): (k, d, 0) for k, d, _ in (row(0) for _ in range(150))}.values()]
    I.create_indexed(spark, frame(spark, *first), path, ["k", "day"], slot_rows=5, file_rows=20)
    want = frame(spark, *first)
    for n in range(3):
        load = frame(spark, *[row(draw.randint(1, 99)) for _ in range(40)])
        update = ["v"] if n == 1 else None
        want = upsert(want, load, ["k", "day"], null_safe, update, dedupe_order=["v"])
        want = spark.createDataFrame(want.collect(), SCHEMA)
        assert I.merge_indexed(spark, load, path, f"l{n}", null_safe, update, dedupe_order=["v"])
        assert rows(I.read_indexed(spark, path)) == rows(want)
    assert len(I._versions(spark, path)) == 4


def test_a_load_is_merged_once(spark, table):
    assert I.merge_indexed(spark, frame(spark, (1, "a", 5)), table, "x")
    assert not I.merge_indexed(spark, frame(spark, (1, "a", 6)), table, "x")
    shutil.rmtree(f"{table}/loads/x")  # the driver was lost between the rename and the mark
    assert not I.merge_indexed(spark, frame(spark, (1, "a", 6)), table, "x")
    assert I.read_indexed(spark, table).where("k = 1").first().v == 5
    assert not I.create_indexed(spark, frame(spark), table, ["k", "day"])


@pytest.mark.parametrize("step", ["_write_files", "_finish", "_publish"])
def test_a_crash_leaves_the_version_before(spark, table, monkeypatch, step):
    before = rows(I.read_indexed(spark, table))
    load = frame(spark, (7, "a", 1), (9000, None, 1))

    def lost(*args, **kwargs):
        if step == "_write_files":  # part of the files is there
            args[0].limit(1).write.parquet(f"{table}/data/l")
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(I, step, lost)
        with pytest.raises(OSError):
            I.merge_indexed(spark, load, table, "l")
    assert rows(I.read_indexed(spark, table)) == before
    assert I.merge_indexed(spark, load, table, "l")
    got = I.read_indexed(spark, table)
    assert got.count() == 401 and got.where("v = 1").count() == 2


def test_of_two_loads_at_once_one_is_refused(spark, table, monkeypatch):
    publish = I._publish

    def second_comes_first(spark, path, files, load, number):
        monkeypatch.setattr(I, "_publish", publish)
        I.merge_indexed(spark, frame(spark, (3, "a", 8)), path, "second")
        publish(spark, path, files, load, number)

    monkeypatch.setattr(I, "_publish", second_comes_first)
    with pytest.raises(I.LoadConflictError):
        I.merge_indexed(spark, frame(spark, (3, "a", 7)), table, "first-load")
    assert I.read_indexed(spark, table).where("k = 3").first().v == 8
    assert I.merge_indexed(spark, frame(spark, (3, "a", 7)), table, "first-load")
    assert I.read_indexed(spark, table).where("k = 3").first().v == 7


def test_old_files_are_dropped_on_request(spark, table):
    for n in range(2):
        I.merge_indexed(spark, frame(spark, *[(k, "a" if k % 2 else None, n + 1) for k in range(400)]), table, f"all{n}")
    want = rows(I.read_indexed(spark, table))
    assert I.drop_old(spark, table) == ["all0", "first"]
    assert rows(I.read_indexed(spark, table)) == want and sorted(os.listdir(f"{table}/data")) == ["all1"]
    I.merge_indexed(spark, frame(spark, (1, "a", 9)), table, "after")
    assert I.read_indexed(spark, table).where("v = 9").count() == 1


def test_stream_of_loads(spark, table, tmp_path):
    source = str(tmp_path / "in")
    for v in (1, 2):
        frame(spark, (1, "a", v), (5000 + v, "z", v)).coalesce(1).write.mode("append").json(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(source)
    stream_upsert_indexed(spark, stream, table, ["v"], str(tmp_path / "c")).awaitTermination()
    got = I.read_indexed(spark, table)
    assert got.count() == 402 and got.where("k = 1").count() == 1 and len(I._versions(spark, table)) == 3


def test_only_touched_files_are_scanned(spark, table):
    """The plan of the rewrite names the touched files, and finding them reads no data file."""
    index = spark.read.parquet(f"{table}/index/first")
    touched = I._touched(frame(spark, (7, "a", 1)), index, I._live(spark, table), ["k", "day"], I._layout(spark, table)["slots"], True)
    assert all("/data/" not in f for f in touched.inputFiles()) and touched.count() == 1
    assert "CartesianProduct" not in touched._jdf.queryExecution().executedPlan().toString()
    assert index.agg(F.sum("n")).first()[0] == 400
