"""Streaming jobs over events, each with its batch twin's oracle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bazaar.checks.registry import check, table
from bazaar.session import work_folder
from bazaar.streaming import retries as Rt
from bazaar.streaming import retry_state as Rs
from bazaar.streaming.upserts import stream_upsert as run_upsert

_FIELDS = """
  CASE WHEN event_type IN ('view', 'click') THEN 'pasar' ELSE 'toko' END AS marketplace,
  event_type AS page_type, CAST(user_id % 7 AS INTEGER) AS start_page,
  CAST(user_id % 7 + 3 AS INTEGER) AS end_page, CAST(event_id % 6 AS INTEGER) AS retry_count,
  CAST(event_id AS VARCHAR) AS target_table
"""
_MESSAGES = f"SELECT {_FIELDS} FROM events"


def messages(spark, d):
    """Events as retry message texts."""
    body = F.struct(
        F.when(F.col("event_type").isin("view", "click"), "pasar").otherwise("toko").alias("marketplace"),
        F.lit("extract").alias("job_type"),
        F.col("event_type").alias("page_type"),
        (F.col("user_id") % 7).alias("start_page"),
        (F.col("user_id") % 7 + 3).alias("end_page"),
        F.lit("raw").alias("bucket_name"),
        F.lit("assets/json").alias("base_path"),
        F.lit("2024-01-31").alias("run_date"),
        F.col("event_id").cast("string").alias("target_table"),
        F.lit("schema.json").alias("schema_path"),
        (F.col("event_id") % 6).alias("retry_count"),
    )
    return table(spark, d, "events").select(F.to_json(body).alias("value"))


def message_stream(spark, d, label):
    path = work_folder(spark, label)
    messages(spark, d).write.text(path)
    return Rt.read_retry_stream(spark, "text", path=path)


def _brief(df):
    return df.select("marketplace", "page_type", "start_page", "end_page", "retry_count", "target_table")


def failures(parsed):
    """Every message fails on its first page, or two pages on when the counter is even."""
    later = F.when(F.col("retry_count") % 2 == 0, 2).otherwise(0)
    return parsed.withColumn("failed_page", F.col("start_page") + later)


_ROUTES = f"""
SELECT marketplace, page_type, target_table, CASE WHEN n <= 3 THEN 'retry' ELSE 'dead' END AS route,
  CASE WHEN n <= 3 THEN failed ELSE start_page END AS start_page,
  CASE WHEN n <= 3 THEN failed + 1 ELSE end_page END AS end_page,
  CAST(CASE WHEN n <= 3 THEN n + 1 ELSE retry_count END AS INTEGER) AS retry_count
FROM (SELECT *, CAST(start_page + CASE WHEN retry_count % 2 = 0 THEN 2 ELSE 0 END AS INTEGER) AS failed,
  CASE WHEN retry_count % 2 = 0 THEN 0 ELSE retry_count END AS n FROM ({_MESSAGES}))
"""


@check("stream_parse_batch", _MESSAGES)
def stream_parse_batch(spark, d):
    return _brief(Rt.parse_retry_messages(messages(spark, d)))


@check("stream_parse", _MESSAGES)
def stream_parse(spark, d):
    out = work_folder(spark, "parsed")
    parsed = Rt.parse_retry_messages(message_stream(spark, d, "messages"))
    Rt.write_stream(parsed, out, work_folder(spark, "offsets")).awaitTermination()
    return _brief(spark.read.parquet(out))


@check("route_retries", _ROUTES)
def route_retries(spark, d):
    routed = Rt.route_retries(failures(Rt.parse_retry_messages(messages(spark, d))))
    return routed.select(
        "marketplace", "page_type", "target_table", "route", "start_page", "end_page", "retry_count"
    )


@check("stream_route", _ROUTES)
def stream_route(spark, d):
    sinks = {"retry": work_folder(spark, "retry"), "dead": work_folder(spark, "dead")}
    routed = Rt.route_retries(failures(Rt.parse_retry_messages(message_stream(spark, d, "failures"))))
    Rt.write_routes(routed, "route", sinks, work_folder(spark, "offsets")).awaitTermination()
    both = spark.read.parquet(sinks["retry"]).unionByName(spark.read.parquet(sinks["dead"]))
    return both.select("marketplace", "page_type", "target_table", "route", "start_page", "end_page", "retry_count")


@check("stream_dispatch", f"SELECT *, marketplace AS sink FROM ({_MESSAGES})")
def stream_dispatch(spark, d):
    sinks = {"pasar": work_folder(spark, "pasar"), "toko": work_folder(spark, "toko")}
    parsed = Rt.parse_retry_messages(message_stream(spark, d, "jobs"))
    Rt.write_routes(parsed, "marketplace", sinks, work_folder(spark, "offsets")).awaitTermination()
    each = [spark.read.parquet(path).withColumn("sink", F.lit(name)) for name, path in sinks.items()]
    return each[0].unionByName(each[1]).select(
        "marketplace", "page_type", "start_page", "end_page", "retry_count", "target_table", "sink"
    )


@check(
    "stream_upsert",
    """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""",
)
def stream_upsert(spark, d):
    """Latest event per user and kind, merged as three spans of time arrive."""
    source, path, offsets = (work_folder(spark, n) for n in ("arrivals", "current", "offsets"))
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts")
    day = F.to_date("ts")
    for span in (day < "2024-01-11", (day >= "2024-01-11") & (day < "2024-01-21"), day >= "2024-01-21"):
        events.filter(span).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        run_upsert(
            spark, stream, path, ["user_id", "event_type"], ["ts", "event_id"], offsets
        ).awaitTermination()
    return spark.read.parquet(path).select("user_id", "event_type", "event_id", "value")


@check("stream_resume", _MESSAGES)
def stream_resume(spark, d):
    """Two runs on one checkpoint: the second reads only what arrived since."""
    source, out, offsets = (work_folder(spark, n) for n in ("inbox", "seen", "offsets"))
    every = messages(spark, d)
    first = F.get_json_object("value", "$.marketplace") == "pasar"
    for part in (every.filter(first), every.filter(~first)):
        part.write.mode("append").text(source)
        parsed = Rt.parse_retry_messages(Rt.read_retry_stream(spark, "text", path=source))
        Rt.write_stream(parsed, out, offsets).awaitTermination()
    return _brief(spark.read.parquet(out))


_COUNTED = """
WITH gaps AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER o > INTERVAL 36 HOUR THEN 1 ELSE 0 END AS starts FROM events
  WINDOW o AS (PARTITION BY user_id, event_type ORDER BY ts, CAST(event_id AS VARCHAR))),
spells AS (
  SELECT *, sum(starts) OVER (PARTITION BY user_id, event_type ORDER BY ts, CAST(event_id AS VARCHAR)) AS spell FROM gaps),
counted AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id, event_type, spell ORDER BY ts, CAST(event_id AS VARCHAR)) AS INTEGER) AS n
  FROM spells)
SELECT user_id, event_type, CAST(event_id AS VARCHAR) AS failure_id, n AS retry_count,
  CASE WHEN n <= 3 THEN 'retry' ELSE 'dead' END AS route
FROM counted
"""
_ITEM = ["user_id", "event_type"]


def work_failures(spark, d):
    """Events as failures of the work item (user, kind); every fifth message is sent twice."""
    every = table(spark, d, "events").select(
        *_ITEM, F.col("event_id").cast("string").alias("failure_id"), F.col("ts").cast("timestamp").alias("failed_at")
    )
    return every.union(every.where("cast(failure_id as bigint) % 5 = 0"))


def _counts(df):
    return df.select(*_ITEM, "failure_id", "retry_count", "route")


@check("retry_state_batch", _COUNTED)
def retry_state_batch(spark, d):
    return _counts(Rs.count_retries_batch(work_failures(spark, d), _ITEM, dt.timedelta(hours=36)))


@check("stream_retry_state", _COUNTED)
def stream_retry_state(spark, d):
    """The counters kept in state over three runs on one checkpoint."""
    source, out, offsets = (work_folder(spark, n) for n in ("failures", "counted", "offsets"))
    failures = work_failures(spark, d)
    day = F.to_date("failed_at")
    with Rs.with_rocks(spark):
        for span in (day < "2024-01-11", (day >= "2024-01-11") & (day < "2024-01-21"), day >= "2024-01-21"):
            failures.filter(span).write.mode("append").parquet(source)
            stream = spark.readStream.schema(failures.schema).parquet(source)
            counted = Rs.count_retries(stream, _ITEM, dt.timedelta(hours=36))
            Rt.write_stream(counted, out, offsets).awaitTermination()
    return _counts(spark.read.parquet(out))
