"""Report dates, periods and request windows.

The clock is always a column or literal given by the caller.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Date layouts of the source reports.
REPORT_FORMATS = {
    "day_first_seconds": "d/M/yyyy H:mm:ss",
    "day_first_dash_minutes": "d-M-yyyy H:mm",
    "short_month_minutes": "d MMM yyyy H:mm",
    "year_first_slash_minutes": "yyyy/M/d/ H:mm",
    "month_first_dash": "M-d-yyyy",
    "day_first_offset": "d/M/yyyy 'GMT+7'",
    "day_first": "d/M/yyyy",
    "year_first_seconds": "yyyy/M/d H:mm:ss",
    "iso_day": "yyyy-M-d",
}

# Month names, full and short, Indonesian and English.
MONTHS = {
    "januari": 1, "februari": 2, "maret": 3, "april": 4, "mei": 5, "juni": 6,
    "juli": 7, "agustus": 8, "september": 9, "oktober": 10, "november": 11, "desember": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "agu": 8,
    "sep": 9, "okt": 10, "nov": 11, "des": 12, "may": 5, "aug": 8, "oct": 10, "dec": 12,
}

# Short month names as printed by the seller portal.
MONTH_LABELS = ("Jan", "Feb", "Mar", "Apr", "Mei", "Jun", "Jul", "Agu", "Sep", "Okt", "Nov", "Des")

BUSINESS_ZONE = "Asia/Jakarta"
MAX_RANGE_DAYS = 30


# Text a run of pattern letters can stand for; a single letter takes one or two digits.
_LETTER_SHAPES = {"yyyy": "[0-9]{4}", "MMM": "[A-Za-z]+", "MM": "[0-9]{2}", "dd": "[0-9]{2}", "HH": "[0-9]{2}",
                  "mm": "[0-9]{2}", "ss": "[0-9]{2}"}


def _shape(fmt: str) -> str:
    """Regular expression that every text of a date format fits."""
    parts = re.finditer(r"'(?P<quoted>[^']*)'|(?P<letters>([A-Za-z])\3*)|(?P<sign>.)", fmt)
    shapes = [
        _LETTER_SHAPES.get(p["letters"], "[0-9]{1,2}") if p["letters"] else re.escape(p["quoted"] or p["sign"])
        for p in parts
    ]
    return f"^{''.join(shapes)}$"


def parse_dates(text: Column, *formats: str) -> Column:
    """First format that fits gives the timestamp; none gives NULL.

    Texts of another shape are not handed to the parser: its failures are slow.
    """
    bare = F.trim(text)
    return F.coalesce(*[F.when(bare.rlike(_shape(f)), F.try_to_timestamp(bare, F.lit(f))) for f in formats])


def parse_id_date(text: Column) -> Column:
    """``7 Agu 2023`` or ``17-Agustus-2023`` to a date."""
    shape = r"([0-9]{1,2})[ -]([A-Za-z]+)[ -]([0-9]{4})"
    names = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    month = F.try_element_at(names, F.lower(F.regexp_extract(text, shape, 2)))
    iso = F.concat_ws(
        "-", F.regexp_extract(text, shape, 3), month.cast("string"), F.regexp_extract(text, shape, 1)
    )
    return F.to_date(F.when(month.isNotNull(), F.try_to_timestamp(iso, F.lit("yyyy-M-d"))))


def id_date_text(day: Column) -> Column:
    """Date to the portal's ``dd Mmm yyyy`` text."""
    labels = F.array(*[F.lit(x) for x in MONTH_LABELS])
    return F.concat_ws(
        " ", F.date_format(day, "dd"), F.element_at(labels, F.month(day)), F.date_format(day, "yyyy")
    )


def split_date_range(
    text: Column, fmt: str = "d/M/yyyy", sep: str = " - ", prefix: str = ""
) -> tuple[Column, Column]:
    """(start, end) dates of a range text."""
    bare = F.replace(text, F.lit(prefix), F.lit("")) if prefix else text
    parts = F.split(bare, f"\\Q{sep}\\E")
    first, last = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(-1))
    return (
        F.to_date(F.try_to_timestamp(F.trim(first), F.lit(fmt))),
        F.to_date(F.try_to_timestamp(F.trim(last), F.lit(fmt))),
    )


def business_day(moment: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Local calendar day of a UTC moment."""
    return F.to_date(F.from_utc_timestamp(moment, zone))


def report_period(today: Column, kind: str) -> tuple[Column, Column]:
    """(start, end) of a reporting period seen from ``today``.

    Kinds: ``today``, ``last_7``, ``last_30``, ``current_week`` (Monday to
    today), ``current_month`` (whole month), ``month_to_date`` and
    ``previous_7`` (seven full days ending yesterday).
    """
    first = F.trunc(today, "month")
    periods = {
        "today": (today, today),
        "last_7": (F.date_sub(today, 6), today),
        "last_30": (F.date_sub(today, 29), today),
        "current_week": (F.to_date(F.date_trunc("week", today)), today),
        "current_month": (first, F.last_day(today)),
        "month_to_date": (first, today),
        "previous_7": (F.date_sub(today, 7), F.date_sub(today, 1)),
    }
    return periods[kind]


def clamp_period_end(start: Column, end: Column) -> Column:
    """End date held inside the month of the start date."""
    return F.least(end, F.last_day(start))


def valid_period(start: Column, end: Column, max_days: int = MAX_RANGE_DAYS) -> Column:
    """True when the range is ordered, short enough and inside one month."""
    return (
        (F.datediff(end, start) <= max_days)
        & (F.datediff(end, start) >= 0)
        & (F.trunc(start, "month") == F.trunc(end, "month"))
    )


def request_window(
    page: Column, start: Column, end: Column, today: Column, sales_days: Column, ads_days: Column
) -> tuple[Column, Column]:
    """(start, end) a report page has to be asked for.

    A range equal to the default (six days back until today) is replaced by the
    page's own rule: sales go ``sales_days`` back, ads go ``ads_days`` back and
    end yesterday, statistic and operational pages cover the month so far up to
    yesterday, or the rest of the previous month on the first day of one. Any
    other range is kept, except that ads end one day earlier and an invalid
    range for statistic or operational pages gives NULL.
    """
    default = (start == F.date_sub(today, 6)) & (end == today)
    monthly = page.isin("statistic", "operational")
    month_start = F.dayofmonth(end) == 1
    first = (
        F.when(default & (page == "sales"), F.date_sub(today, sales_days))
        .when(default & (page == "ads"), F.date_sub(today, ads_days))
        .when(default & monthly & ~month_start, F.trunc(today, "month"))
        .when(~default & monthly & ~valid_period(start, end), None)
        .otherwise(start)
    )
    last = (
        F.when(default & (page == "ads"), F.date_sub(today, 1))
        .when(default & monthly & month_start, clamp_period_end(start, end))
        .when(default & monthly, F.date_sub(today, 1))
        .when(~default & (page == "ads"), F.date_sub(end, 1))
        .when(~default & monthly & ~valid_period(start, end), None)
        .otherwise(end)
    )
    return first, last


def explode_days(df: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """One row per day of each row's [start, end]; an inverted range has no days."""
    days = F.when(
        F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))
    )
    return df.withColumn(name, F.explode(days))


def epoch_to_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm")
