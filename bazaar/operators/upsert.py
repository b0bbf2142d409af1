"""Upsert on plain Parquet tables.

The match is planned so that a large target is shuffled only when the source is
too large to broadcast, and so that a hot key in the target (a third of the rows
under one NULL key, say) can be split by AQE: the target side is the left side of
a left outer join, never a side of a full outer join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.operators.dedupe import dedupe


class DuplicateKeyError(ValueError):
    """The source holds several rows for one key and no order to choose by."""


def _key(df: DataFrame, other: DataFrame, name: str) -> Column:
    """Keys of one type compare as they are; differing types compare as text."""
    same = df.schema[name].dataType == other.schema[name].dataType
    return F.col(name) if same else F.col(name).cast("string")


def _keys(df: DataFrame, other: DataFrame, keys: list[str], mark: str) -> list[Column]:
    return [_key(df, other, k).alias(f"{mark}{i}") for i, k in enumerate(keys)]


def _match(count: int, left: str, right: str) -> Column:
    pairs = [F.col(f"{left}{i}").eqNullSafe(F.col(f"{right}{i}")) for i in range(count)]
    return reduce(lambda a, b: a & b, pairs)


def check_unique(source: DataFrame, keys: list[str], null_safe: bool = True) -> None:
    """Raise when a key repeats. Pre-aggregates, so one hot key costs nothing extra."""
    rows = source if null_safe else source.dropna(subset=keys)
    twice = rows.groupBy(*keys).count().filter("count > 1").limit(1).count()
    if twice:
        raise DuplicateKeyError(f"source repeats a key of {keys}; give a dedupe order")


def one_per_key(
    source: DataFrame, keys: list[str], order: list[str] | None, null_safe: bool = True, keep: str = "latest"
) -> DataFrame:
    """The source with one row per key: chosen by ``order``, or checked to be so.

    Without ``null_safe`` rows with a NULL key part match nothing and all stay.
    """
    if not order:
        check_unique(source, keys, null_safe)
        return source
    if null_safe:
        return dedupe(source, keys, order, keep)
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    lone = "_lone"
    while lone in source.columns:
        lone += "_"
    alone = source.withColumn(lone, F.when(has_null, F.monotonically_increasing_id()))  # a key of its own for each
    return dedupe(alone, [*keys, lone], order, keep).drop(lone)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    null_safe: bool = True,
    update_columns: list[str] | None = None,
    dedupe_order: list[str] | None = None,
    keep: str = "latest",
    checked: bool = False,
) -> DataFrame:
    """Target after the merge: matched rows updated, other source rows added.

    ``null_safe`` lets NULL keys match each other; without it a NULL key never
    matches and is added on every run. ``update_columns`` limits what a match
    overwrites (default: all). The source is deduped by ``dedupe_order``, or
    checked to have unique keys, unless the caller has ``checked`` that already.
    """
    rows = source if checked else one_per_key(source, keys, dedupe_order, null_safe, keep)
    columns = target.columns
    changed = set(update_columns if update_columns is not None else columns)
    # One struct, so that both joins need the same columns of the source and share one shuffle of it.
    new = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    incoming = rows.select(*_keys(rows, target, keys, "_s"), new.alias("_new"))
    current = target.select(*_keys(target, rows, keys, "_t"), *columns)
    # The match is null-safe in any case: its shuffle differs from the dedupe's, so both join sides are fresh
    # shuffles and AQE may split a hot key. Strict keys add that none is NULL: said of the left side, where it
    # filters nothing before the join, so both joins still read the same rows of the source.
    def match(left: str) -> Column:
        strict = [] if null_safe else [F.col(f"{left}{i}").isNotNull() for i in range(len(keys))]
        return reduce(lambda a, b: a & b, strict, _match(len(keys), "_t", "_s"))

    updated = current.join(incoming, match("_t"), "left").select(
        *[
            (F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)) if c in changed else F.col(c)).alias(c)
            for c in columns
        ]
    )
    # Of the target only its keys, each once for a task, so a hot one costs nothing extra.
    known = target.select(*_keys(target, rows, keys, "_t")).distinct()
    added = incoming.join(known, match("_s"), "left_anti").select(*[F.col("_new")[c].alias(c) for c in columns])
    return updated.unionByName(added)
