"""Row predicates of the collected and reconciled tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def day_range(moment: Column, first_day: str, last_day: str) -> Column:
    """Inclusive day range as a half-open comparison the scan can push down."""
    start = F.lit(first_day).cast("timestamp_ntz")
    after = F.date_add(F.lit(last_day).cast("date"), 1).cast("timestamp_ntz")
    return (moment >= start) & (moment < after)


def none_of_patterns(text: Column, patterns: list[str]) -> Column:
    return ~F.lower(text).rlike("|".join(patterns))


def contains_squeezed(text: Column, words: str) -> Column:
    """Literal containment, blanks ignored on both sides."""
    return F.contains(F.replace(text, F.lit(" "), F.lit("")), F.lit(words.replace(" ", "")))


def without_words(tokens: Column, stop_words: list[str]) -> Column:
    """Tokens that are not on the stop list."""
    listed = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(tokens, lambda t: ~F.array_contains(listed, t))


def hash_sample(df: DataFrame, key: str, seed: int, keep: int, out_of: int) -> DataFrame:
    """Repeatable sample: a row is in by the hash of its key, wherever it is stored.

    MD5 is used because every engine computes the same one.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    spread = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.filter(spread % out_of < keep)


def random_sample(df: DataFrame, fraction: float, limit: int, seed: int | None = None) -> DataFrame:
    """A few random rows."""
    return df.sample(fraction=fraction, seed=seed).limit(limit)


def has_more_than(df: DataFrame, n: int) -> bool:
    """Arrival gate; reads no further than n + 1 rows."""
    return df.limit(n + 1).count() > n
