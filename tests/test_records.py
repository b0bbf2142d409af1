"""Records with quoted line breaks across splits, and tables read by each file's own header."""

import csv
import io
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.operators.headers import header_expression
from bazaar.sources import records, reports
from tests.test_sources import put, small_splits  # noqa: F401


def written(seed, files):
    """CSV files of odd cells, with LF or CRLF, some with a byte order mark, and their cells by Python's reader."""
    draw = random.Random(seed)
    cells = ["a", "", "x,y", 'q"q', "l1\nl2", "\n\n\n", '"', "é\r\nz", "5" * 30, '""\n"', "tail ", 'a"b']
    for k in range(files):
        out = io.StringIO()
        rows = [[draw.choice(cells) for _ in range(draw.randint(1, 4))] for _ in range(draw.choice([0, 1, 5, 120]))]
        csv.writer(out, lineterminator=draw.choice(["\n", "\r\n"])).writerows(rows)
        text = out.getvalue()
        yield f"f{k}.csv", ("﻿" if k % 3 == 0 else "") + text, [r or [""] for r in csv.reader(io.StringIO(text, newline=""))]


def test_records_across_splits(spark, tmp_path, small_splits):  # noqa: F811
    want = {}
    for name, text, rows in written(1, 12):
        put(tmp_path, name, text.encode())
        want |= {(name, i): [c or None for c in r] for i, r in enumerate(rows)}
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    found = records.read_records(spark, str(tmp_path)).select("path", "row_no", records.record_cells(F.col("record")).alias("cells"))
    got = [((os.path.basename(r.path), r.row_no), list(r.cells)) for r in found.collect()]
    assert len(got) == len(want) and dict(got) == want


def test_plain_lines_keep_their_quotes(spark, tmp_path, small_splits):  # noqa: F811
    lines = [f'{i},"open {"x" * (i % 9)}' for i in range(300)]
    put(tmp_path, "a.csv", "\n".join(lines))
    got = reports.number_lines(spark, str(tmp_path)).collect()
    assert {(r.row_no, r.line) for r in got} == set(enumerate(lines)) and len(got) == 300


@pytest.mark.parametrize("cut", [1, 3, 50])
def test_notes_of_any_batches(cut):
    """Notes of a split do not depend on how its lines are batched, and agree with a line-by-line parse."""
    draw = random.Random(cut)
    n = 200
    blocks = np.sort(np.array([draw.randint(0, 4) for _ in range(n)], np.int64))
    paths = np.array(["p"] * n, object)
    ends = tuple(np.array([draw.random() < 0.5 for _ in range(n)]) for _ in range(2))
    carry, parts = {}, []
    for at in range(0, n, cut):
        parts.append(records._note(paths[at : at + cut], blocks[at : at + cut], tuple(e[at : at + cut] for e in ends), carry))
    found = np.concatenate(parts).tolist()
    for start in (0, 1):
        at, state, record = -1, start, -1
        for i in range(n):
            if i == 0 or blocks[i] != blocks[i - 1]:
                at, state, record = -1, start, -1
            at += 1
            before, record = state, record + (state == 0)
            state = int(ends[state][i])
            assert (found[i][0], found[i][1 + start], found[i][3 + start], found[i][5 + start]) == (at, before, state, record)


def test_one_scan_for_all(spark, tmp_path):
    """The two parses, the states of the splits and the records come from one read and one exchange of the lines."""
    put(tmp_path, "a.csv", 'id,t\n1,"x\ny"\n')
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (
            records.read_records(spark, str(tmp_path)),
            reports.read_report_csv(spark, str(tmp_path), columns=["id", "t"]),
            reports.table_by_header(reports.read_preamble_grid(spark, str(tmp_path)), 0, 1, ["id", "t"]),
        ):
            text = df._jdf.queryExecution().executedPlan().toString()
            assert text.count("FileScan text") == 1 and text.count("MapInArrow") == 1
            assert text.count("ReusedExchange") >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_quoted_line_break_in_both_readers(spark, tmp_path):
    put(tmp_path / "p", "a.csv", 'Judul\nid,t\n1,"x\ny"\n')
    put(tmp_path / "c", "a.csv", 'id,t\n1,"x\ny"\n\n2,""\n')
    grid = reports.read_preamble_grid(spark, str(tmp_path / "p"))
    assert [tuple(r) for r in reports.grid_to_table(grid, ["id", "t"], 2, keep=()).collect()] == [("1", "x\ny")]
    for columns in (None, ["id", "t"]):
        rows = reports.read_report_csv(spark, str(tmp_path / "c"), columns=columns).orderBy("id").collect()
        assert [tuple(r) for r in rows] == [("1", "x\ny"), ("2", "")]


def jobs_of(spark, make):
    """Jobs that ``make`` starts."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    out = make()
    return out, len(set(tracker.getJobIdsForGroup(None)) - before)


def test_files_with_their_own_headers(spark, tmp_path):
    put(tmp_path, "a.csv", "Kode,Nama Barang,Jumlah\n1,satu,5\n")
    put(tmp_path, "b.csv", "Jumlah, Code ,Item Name,Note\n7,2,two,x\n,3,three,\n")
    put(tmp_path, "c.csv", "Kode,Code\n,4\n5,6\n")
    words = {"Kode": "code", "Code": "code", "Nama Barang": "item_name"}
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    rank = F.create_map(*[F.lit(x) for i, word in enumerate(words) for x in (word, i)])

    def make():
        grid = reports.read_preamble_grid(spark, str(tmp_path))
        return reports.table_by_header(
            grid, 0, 1, ["code", "item_name", "jumlah"],
            name_of=lambda h: F.coalesce(F.try_element_at(table, h), header_expression(h, "words")),
            rank_of=lambda h: F.try_element_at(rank, h), keep=(),
        )

    df, jobs = jobs_of(spark, make)
    assert jobs == 0
    assert [tuple(r) for r in df.orderBy("code").collect()] == [
        ("1", "satu", "5"), ("2", "two", "7"), ("3", "three", None), ("4", None, None), ("5", None, None),
    ]


def test_csv_columns_by_name_and_refusals(spark, tmp_path):
    put(tmp_path / "a", "1.csv", "x,y\n1,2\n")
    put(tmp_path / "a", "2.csv", "y,x\n4,3\n")
    assert {tuple(r) for r in reports.read_report_csv(spark, str(tmp_path / "a")).select("x", "y").collect()} == {("1", "2"), ("3", "4")}
    put(tmp_path / "b", "1.csv", "x,y\n1,2\n")
    put(tmp_path / "b", "2.csv", "x,z\n1,2\n")
    with pytest.raises(Exception, match="differing headers"):
        reports.read_report_csv(spark, str(tmp_path / "b")).collect()
    put(tmp_path / "c", "1.csv", "a,b,a\n1,2,3\n")
    twice = reports.read_report_csv(spark, str(tmp_path / "c"))
    assert twice.columns == ["a0", "b", "a2"] and tuple(twice.first()) == ("1", "2", "3")
    grid = reports.read_preamble_grid(spark, str(tmp_path / "b"))
    refused = reports.table_by_header(
        grid, 0, 1, ["x"], refuse=lambda names: F.when(~F.array_contains(names, "y"), F.lit("it lacks y"))
    )
    with pytest.raises(Exception, match="lacks y"):
        refused.collect()


def test_no_task_joins_a_file_whole(spark, tmp_path):
    """Rows of one file meet its header in several tasks, whatever way the join is done."""
    put(tmp_path, "a.csv", "id,t\n" + "".join(f'{i},"x\ny"\n' for i in range(400)))
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        preamble = reports.read_preamble_grid(spark, str(tmp_path))
        for df in (
            reports.read_report_csv(spark, str(tmp_path)),
            reports.table_by_header(preamble, 0, 1, ["id", "t"], keep=()),
            reports.table_by_place(preamble, 0, 1, [["id", "t"]], keep=()),
        ):
            dealt = [r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
            assert sum(dealt) == 400 and len(dealt) > 1 and max(dealt) < 300
            assert {(r.id, r.t) for r in df.collect()} == {(str(i), "x\ny") for i in range(400)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
