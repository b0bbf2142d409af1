"""Numeric rules of catalogue rows and metric reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: catalogue prices are stored multiplied by this.
PRICE_SCALE = 100000


def scale_price(raw: Column, positive_only: bool = False) -> Column:
    """Stored price to currency units, fraction cut off.

    With ``positive_only`` zero and negative values pass through unscaled.
    """
    scaled = (raw / F.lit(PRICE_SCALE)).cast("bigint")
    return F.when(raw > 0, scaled).otherwise(raw.cast("bigint")) if positive_only else scaled


def price_fallback(original: Column, final: Column) -> Column:
    return F.when(original == 0, final).otherwise(original)


def gap_percent(found: Column, expected: Column) -> Column:
    """Percentage of ``expected`` that was not found; NULL when nothing is expected."""
    return F.round(F.lit(100.0) - F.try_divide(found, expected) * 100.0, 2)


def total(*parts: Column) -> Column:
    """Sum in which one missing part makes the total missing."""
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def remainder(whole: Column, *parts: Column) -> Column:
    """What is left of ``whole`` after the parts; missing if any is missing."""
    out = whole
    for part in parts:
        out = out - part
    return out
