import os

import pytest
from pyspark.sql import functions as F

from bazaar.streaming import retries as Rt
from bazaar.streaming.upserts import bounded_dedupe, stream_upsert
from tests.test_operators import rows


def message(**changes):
    import json

    return json.dumps({"marketplace": "m", "page_type": "p", "start_page": 1, "end_page": 5, "retry_count": 0, **changes})


def test_parse_keeps_broken_messages(spark):
    raw = spark.createDataFrame([(message(),), ("broken",), (None,)], "value string")
    parsed = Rt.parse_retry_messages(raw).collect()
    assert parsed[0].end_page == 5 and parsed[0]._corrupt_record is None
    assert parsed[1].start_page is None and parsed[1]._corrupt_record == "broken"


@pytest.mark.parametrize(
    "start,failed,count,route,pages,after",
    [
        (1, 1, 0, "retry", (1, 2), 1),
        (1, 1, 3, "retry", (1, 2), 4),
        (1, 1, 4, "dead", (1, 5), 4),
        (1, 3, 9, "retry", (3, 4), 1),
    ],
)
def test_routes(spark, start, failed, count, route, pages, after):
    raw = spark.createDataFrame([(message(start_page=start, retry_count=count),)], "value string")
    row = Rt.route_retries(Rt.parse_retry_messages(raw).withColumn("failed_page", F.lit(failed))).first()
    assert (row.route, (row.start_page, row.end_page), row.retry_count) == (route, pages, after)


def test_several_categories_reset_the_counter(spark):
    df = spark.createDataFrame([(1, 1, 3, 2), (1, 1, 3, 1)], "page int, start int, n int, specs int")
    counted = Rt.next_retry_count(F.col("page"), F.col("start"), F.col("n"), F.col("specs"))
    assert [r[0] for r in df.select(counted).collect()] == [0, 3]


def test_two_runs_read_nothing_twice(spark, tmp_path):
    source, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    for part in (range(0, 5), range(5, 8)):
        lines = [(message(start_page=i),) for i in part]
        spark.createDataFrame(lines, "value string").write.mode("append").text(source)
        Rt.write_stream(Rt.parse_retry_messages(Rt.read_retry_stream(spark, "text", path=source)), out, offsets).awaitTermination()
    assert sorted(r.start_page for r in spark.read.parquet(out).collect()) == list(range(8))


def test_stream_equals_batch_merge(spark, tmp_path):
    source, path, offsets = (str(tmp_path / n) for n in ("in", "t", "offsets"))
    schema = "k int, t int, v string"
    for n, batch in enumerate([[(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], [(1, 3, "d"), (3, 1, "e")]]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        stream_upsert(spark, stream, path, ["k"], ["t"], offsets).awaitTermination()
    assert rows(spark.read.parquet(path)) == rows(
        spark.createDataFrame([(1, 3, "d"), (2, 1, "c"), (3, 1, "e")], schema)
    )
    assert sorted(os.listdir(f"{offsets}-merges")) == ["0", "1"]


def test_bounded_dedupe(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("SELECT 1 AS k, TIMESTAMP'2024-01-01 00:00:00' AS t UNION ALL SELECT 1, TIMESTAMP'2024-01-01 00:00:05'").write.parquet(source)
    stream = bounded_dedupe(spark.readStream.schema("k int, t timestamp").parquet(source), ["k"], "t", "1 minute")
    Rt.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "o")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
