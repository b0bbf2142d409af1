"""Date functions on order and event dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.checks.registry import check, day_text, minute_text, table
from bazaar.functions import dates as D


@check(
    "parse_dates",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS seconds,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dashes, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS month_name,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS slashes, strftime(o_orderdate, '%Y-%m-%d') AS month_first,
  strftime(o_orderdate, '%Y-%m-%d') AS with_offset, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS several,
  CAST(NULL AS VARCHAR) AS broken
FROM orders
""",
)
def parse_dates(spark, d):
    when, fmt = F.col("o_orderdate"), D.REPORT_FORMATS
    shown = table(spark, d, "orders").select(
        "o_orderkey",
        F.date_format(when, "dd/MM/yyyy HH:mm:ss").alias("seconds"),
        F.date_format(when, "dd-MM-yyyy HH:mm").alias("dashes"),
        F.date_format(when, "dd MMM yyyy HH:mm").alias("month_name"),
        F.date_format(when, "yyyy/MM/dd/ HH:mm").alias("slashes"),
        F.date_format(when, "MM-dd-yyyy").alias("month_first"),
        F.concat(F.date_format(when, "dd/MM/yyyy"), F.lit(" GMT+7")).alias("with_offset"),
        F.concat(F.lit("32/"), F.date_format(when, "MM/yyyy HH:mm:ss")).alias("broken"),
    ).withColumn("several", F.when(F.col("o_orderkey") % 2 == 0, F.col("seconds")).otherwise(F.col("dashes")))
    layouts = {
        "seconds": ["day_first_seconds"],
        "dashes": ["day_first_dash_minutes"],
        "month_name": ["short_month_minutes"],
        "slashes": ["year_first_slash_minutes"],
        "month_first": ["month_first_dash"],
        "with_offset": ["day_first_offset"],
        "several": ["day_first_seconds", "day_first_dash_minutes"],
        "broken": ["day_first_seconds"],
    }
    as_text = {"month_first": day_text, "with_offset": day_text}
    return shown.select(
        "o_orderkey",
        *[
            as_text.get(name, minute_text)(D.parse_dates(F.col(name), *[fmt[key] for key in keys])).alias(name)
            for name, keys in layouts.items()
        ],
    )


SHORT = "['Jan','Feb','Mar','Apr','Mei','Jun','Jul','Agu','Sep','Okt','Nov','Des']"


@check(
    "parse_id_months",
    f"""
SELECT o_orderkey, strftime(o_orderdate, '%d') || ' ' || ({SHORT})[month(o_orderdate)] || ' ' || strftime(o_orderdate, '%Y')
    AS label,
  strftime(o_orderdate, '%Y-%m-%d') AS from_short, strftime(o_orderdate, '%Y-%m-%d') AS from_full,
  CAST(NULL AS VARCHAR) AS unknown
FROM orders
""",
)
def parse_id_months(spark, d):
    when = F.col("o_orderdate")
    names = [n.capitalize() for n in list(D.MONTHS)[:12]]
    full = F.concat_ws(
        "-",
        F.dayofmonth(when).cast("string"),
        F.element_at(F.array(*[F.lit(n) for n in names]), F.month(when)),
        F.year(when).cast("string"),
    )
    label = D.id_date_text(when)
    return table(spark, d, "orders").select(
        "o_orderkey",
        label.alias("label"),
        day_text(D.parse_id_date(label)).alias("from_short"),
        day_text(D.parse_id_date(full)).alias("from_full"),
        day_text(D.parse_id_date(F.concat(F.date_format(when, "dd"), F.lit(" Foo "), F.year(when)))).alias("unknown"),
    )


@check(
    "split_date_range",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS start_date,
  strftime(o_orderdate + INTERVAL 6 DAY, '%Y-%m-%d') AS end_date,
  strftime(o_orderdate, '%Y-%m-%d') AS tagged_start, strftime(o_orderdate + INTERVAL 6 DAY, '%Y-%m-%d') AS tagged_end
FROM orders
""",
)
def split_date_range(spark, d):
    start, end = F.col("o_orderdate"), F.date_add("o_orderdate", 6)
    shown = F.concat_ws(" - ", F.date_format(start, "dd/MM/yyyy"), F.date_format(end, "dd/MM/yyyy"))
    tagged = F.concat(
        F.lit("[Date Range]: "), F.date_format(start, "yyyy-MM-dd"), F.lit(" ~ "), F.date_format(end, "yyyy-MM-dd")
    )
    a, b = D.split_date_range(shown)
    e, f = D.split_date_range(tagged, "yyyy-M-d", "~", "[Date Range]: ")
    return table(spark, d, "orders").select(
        "o_orderkey",
        day_text(a).alias("start_date"),
        day_text(b).alias("end_date"),
        day_text(e).alias("tagged_start"),
        day_text(f).alias("tagged_end"),
    )


PERIOD_SQL = {
    "today": ("t", "t"),
    "last_7": ("t - 6", "t"),
    "last_30": ("t - 29", "t"),
    "current_week": ("CAST(date_trunc('week', t) AS DATE)", "t"),
    "current_month": ("CAST(date_trunc('month', t) AS DATE)", "last_day(t)"),
    "month_to_date": ("CAST(date_trunc('month', t) AS DATE)", "t"),
    "previous_7": ("t - 7", "t - 1"),
}


@check(
    "report_period",
    "SELECT event_id, "
    + ", ".join(
        f"strftime({a}, '%Y-%m-%d') AS {k}_start, strftime({b}, '%Y-%m-%d') AS {k}_end"
        for k, (a, b) in PERIOD_SQL.items()
    )
    + " FROM (SELECT event_id, CAST(ts + INTERVAL 7 HOUR AS DATE) AS t FROM events)",
)
def report_period(spark, d):
    today = D.business_day(F.col("ts").cast("timestamp"))
    rows = table(spark, d, "events").select("event_id", today.alias("t"))
    out = []
    for kind in PERIOD_SQL:
        start, end = D.report_period(F.col("t"), kind)
        out += [day_text(start).alias(f"{kind}_start"), day_text(end).alias(f"{kind}_end")]
    return rows.select("event_id", *out)


@check(
    "clamp_period",
    """
SELECT o_orderkey, strftime(least(CAST(o_orderdate + INTERVAL 20 DAY AS DATE), last_day(o_orderdate)), '%Y-%m-%d') AS end_date
FROM orders
""",
)
def clamp_period(spark, d):
    end = D.clamp_period_end(F.to_date("o_orderdate"), F.date_add("o_orderdate", 20))
    return table(spark, d, "orders").select("o_orderkey", day_text(end).alias("end_date"))


@check(
    "valid_period",
    """
SELECT o_orderkey, date_trunc('month', e) = date_trunc('month', s) AND e - s <= 30 AND e - s >= 0 AS valid
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s,
  CAST(o_orderdate AS DATE) + CAST(o_custkey % 40 AS INTEGER) - 2 AS e FROM orders)
""",
)
def valid_period(spark, d):
    end = F.date_add("o_orderdate", (F.col("o_custkey") % 40 - 2).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", D.valid_period(F.to_date("o_orderdate"), end).alias("valid"))


@check(
    "date_spine",
    """
SELECT o_orderkey, strftime(unnest(generate_series(o_orderdate, o_orderdate + CAST(o_custkey % 4 AS INTEGER) * INTERVAL 1 DAY,
  INTERVAL 1 DAY)), '%Y-%m-%d') AS day
FROM orders
""",
)
def date_spine(spark, d):
    ranges = table(spark, d, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("start"),
        F.date_add("o_orderdate", (F.col("o_custkey") % 4).cast("int")).alias("end"),
    )
    return D.explode_days(ranges, "start", "end").select("o_orderkey", day_text(F.col("day")).alias("day"))


@check(
    "request_window",
    """
WITH plan AS (
  SELECT o_orderkey, ['sales','ads','statistic','operational'][1 + o_custkey % 4] AS page,
    CAST(o_orderdate AS DATE) AS today, CAST(o_orderdate AS DATE) - CAST(CASE WHEN o_orderkey % 2 = 0 THEN 6 ELSE 3 END AS INTEGER) AS s,
    CAST(o_orderdate AS DATE) AS e FROM orders
), judged AS (
  SELECT *, s = today - 6 AS is_default, page IN ('statistic', 'operational') AS monthly,
    date_trunc('month', e) = date_trunc('month', s) AND e - s BETWEEN 0 AND 30 AS valid FROM plan
)
SELECT o_orderkey, page, strftime(CASE
    WHEN is_default AND page = 'sales' THEN today - 30
    WHEN is_default AND page = 'ads' THEN today - 14
    WHEN is_default AND monthly AND day(e) <> 1 THEN CAST(date_trunc('month', today) AS DATE)
    WHEN NOT is_default AND monthly AND NOT valid THEN NULL ELSE s END, '%Y-%m-%d') AS first_day,
  strftime(CASE
    WHEN is_default AND page = 'ads' THEN today - 1
    WHEN is_default AND monthly AND day(e) = 1 THEN least(e, last_day(s))
    WHEN is_default AND monthly THEN today - 1
    WHEN NOT is_default AND page = 'ads' THEN e - 1
    WHEN NOT is_default AND monthly AND NOT valid THEN NULL ELSE e END, '%Y-%m-%d') AS last_day
FROM judged
""",
)
def request_window(spark, d):
    pages = F.array(*[F.lit(p) for p in ("sales", "ads", "statistic", "operational")])
    plan = table(spark, d, "orders").select(
        "o_orderkey",
        F.element_at(pages, (F.col("o_custkey") % 4 + 1).cast("int")).alias("page"),
        F.to_date("o_orderdate").alias("today"),
        F.date_sub("o_orderdate", F.when(F.col("o_orderkey") % 2 == 0, 6).otherwise(3)).alias("s"),
    )
    first, last = D.request_window(
        F.col("page"), F.col("s"), F.col("today"), F.col("today"), F.lit(30), F.lit(14)
    )
    return plan.select("o_orderkey", "page", day_text(first).alias("first_day"), day_text(last).alias("last_day"))


@check(
    "epoch_to_text",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS posted_at FROM events
""",
)
def epoch_to_text(spark, d):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", D.epoch_to_text(seconds).alias("posted_at"))


@check(
    "date_parts",
    """
SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day_start,
  strftime(CAST(ts AS DATE) - 1, '%Y-%m-%d') AS day_before
FROM events
""",
)
def date_parts(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        day_text(F.to_date("ts")).alias("day"),
        minute_text(F.date_trunc("day", "ts")).alias("day_start"),
        day_text(F.date_sub(F.to_date("ts"), 1)).alias("day_before"),
    )
