"""Tables whose merges rewrite only the files that can hold a key of the load.

Below the table's folder lie ``data/<load>`` (files, never changed), ``index/<load>``
(what keys the files of that load hold) and ``versions/<number>`` (the files of
each version). Keys fall into slots by their hash, and a file holds whole runs
of slots. The index has one row for each slot of a file: the smallest and
largest key values and a Bloom filter of the keys (two bitmaps). A merge joins
the load's keys with the index by slot; only files with a slot that may hold
one of them are read and written again. New keys alone make new files and
rewrite none.

A version is written aside and published by one rename, so a reader sees the
version before or the one after, and of two merges at once one is refused. A
load that failed before that leaves the version before as it was and can be
repeated under its name; a load that was published is not repeated.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.operators.upsert import one_per_key, upsert
from bazaar.sinks import versions
from bazaar.sinks.versions import LoadConflictError

__all__ = ["LoadConflictError", "create_indexed", "drop_old", "merge_indexed", "read_indexed"]

SLOT_ROWS = 4000
FILE_ROWS = 1_000_000
_BITS = 32768


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Numbers of the published versions, oldest first."""
    return versions.names(spark, f"{path}/versions")


def _layout(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/layout").first().value)


def _live(spark: SparkSession, path: str) -> DataFrame:
    """``file`` (load/name) and ``n`` (rows) of the newest version."""
    return spark.read.schema("file string, n bigint").parquet(f"{path}/versions/{_versions(spark, path)[-1]}")


def _loads(live: DataFrame) -> list[str]:
    """The loads that the files of a version are from."""
    return sorted(row.load for row in live.select(F.substring_index("file", "/", 1).alias("load")).distinct().toLocalIterator())


def _hashed(df: DataFrame, keys: list[str], slots: int) -> tuple[Column, Column, Column]:
    """Slot of a row's key and its places in the two bitmaps."""
    key = [F.col(k) for k in keys]
    second = F.xxhash64(F.lit(1), *key)
    return (
        F.pmod(F.xxhash64(*key), F.lit(slots)),
        F.pmod(second, F.lit(_BITS)),
        F.pmod(F.shiftright(second, 32), F.lit(_BITS)),
    )


def _has_bit(bitmap: str, place: str) -> Column:
    byte = f"cast(conv(hex(substring({bitmap}, cast({place} div 8 as int) + 1, 1)), 16, 10) as int)"
    return F.expr(f"({byte} & shiftleft(1, cast({place} % 8 as int))) <> 0")


def read_indexed(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the table."""
    schema = T.StructType.fromJson(_layout(spark, path)["schema"])
    files = [f"{path}/data/{row.file}" for row in _live(spark, path).select("file").toLocalIterator()]
    reader = spark.read.schema(schema)
    return reader.parquet(*files) if files else spark.createDataFrame([], schema)


def _write_files(df: DataFrame, path: str, load: str, keys: list[str], slots: int, rows: int, file_rows: int) -> None:
    """Files of whole runs of slots, and their index."""
    spark = df.sparkSession
    slot, *_ = _hashed(df, keys, slots)
    parts = max(1, -(-rows // file_rows))
    out = df.withColumn("_slot", slot).repartitionByRange(parts, "_slot").sortWithinPartitions("_slot").drop("_slot")
    out.write.mode("overwrite").parquet(f"{path}/data/{load}")
    written = spark.read.schema(df.schema).parquet(f"{path}/data/{load}")
    slot, one, two = _hashed(written, keys, slots)
    spans = [F.struct(F.min(k).alias("low"), F.max(k).alias("high"), F.bool_or(F.col(k).isNull()).alias("nulls")) for k in keys]
    index = (
        written.select(*keys, F.col("_metadata.file_name").alias("name"), slot.alias("slot"), one.alias("one"), two.alias("two"))
        .groupBy("name", "slot")
        .agg(
            F.count("*").alias("n"),
            *[span.alias(f"span{i}") for i, span in enumerate(spans)],
            F.bitmap_construct_agg("one").alias("bits1"),
            F.bitmap_construct_agg("two").alias("bits2"),
        )
        .withColumn("file", F.concat(F.lit(f"{load}/"), "name"))
        .drop("name")
    )
    index.write.mode("overwrite").parquet(f"{path}/index/{load}")


def _publish(spark: SparkSession, path: str, files: DataFrame, load: str, number: int) -> None:
    versions.publish(spark, files.select("file", "n"), f"{path}/aside/{load}", f"{path}/versions", number)


def _done(spark: SparkSession, path: str, load: str) -> bool:
    return versions.exists(spark, f"{path}/loads/{load}")


def _touched(rows: DataFrame, index: DataFrame, live: DataFrame, keys: list[str], slots: int, null_safe: bool) -> DataFrame:
    """Live files with a slot that may hold a key of the rows."""
    asked = rows if null_safe else rows.dropna(subset=keys)
    slot, one, two = _hashed(asked, keys, slots)
    asked = asked.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], slot.alias("slot"), one.alias("one"), two.alias("two"))
    inside = [
        F.when(F.col(f"_k{i}").isNull(), F.col(f"span{i}.nulls")).otherwise(F.col(f"_k{i}").between(F.col(f"span{i}.low"), F.col(f"span{i}.high")))
        for i in range(len(keys))
    ]
    may = reduce(lambda a, b: a & b, [*inside, _has_bit("bits1", "one"), _has_bit("bits2", "two")])
    held = index.join(live.select("file"), "file", "left_semi")
    return asked.join(held, "slot").where(may).select("file").distinct()


def create_indexed(
    spark: SparkSession, df: DataFrame, path: str, keys: list[str], load: str = "first",
    slot_rows: int = SLOT_ROWS, file_rows: int = FILE_ROWS,
) -> bool:
    """Make the table from ``df``; False if a load of that name did so already."""
    if _versions(spark, path):
        if _done(spark, path, load):
            return False
        raise ValueError(f"{path} is a table already")
    total = df.count()
    layout = {"keys": keys, "slots": max(1, -(-total // slot_rows)), "file_rows": file_rows, "schema": df.schema.jsonValue()}
    spark.createDataFrame([(json.dumps(layout),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/layout")
    _write_files(df, path, load, keys, layout["slots"], total, file_rows)
    _finish(spark, path, load, spark.createDataFrame([], "file string, n bigint"), 1)
    return True


def _finish(spark: SparkSession, path: str, load: str, kept: DataFrame, number: int) -> None:
    new = spark.read.parquet(f"{path}/index/{load}").groupBy("file").agg(F.sum("n").alias("n"))
    _publish(spark, path, kept.select("file", "n").union(new), load, number)
    versions.make(spark, f"{path}/loads/{load}")


def merge_indexed(
    spark: SparkSession, source: DataFrame, path: str, load: str, null_safe: bool = True,
    update_columns: list[str] | None = None, dedupe_order: list[str] | None = None, keep: str = "latest",
) -> bool:
    """Upsert ``source`` into an indexed table; False if this load is in it already.

    ``load`` names the load. Matches follow ``upsert``: ``null_safe`` keys match
    NULL with NULL, others never match one. The table keeps its columns and
    types. Rows go to new files; files with a matching key are replaced by what
    the merge makes of them, all others stay untouched and unread.
    """
    layout = _layout(spark, path)
    keys, slots, schema = layout["keys"], layout["slots"], T.StructType.fromJson(layout["schema"])
    newest = _versions(spark, path)[-1]
    if _done(spark, path, load) or _in_version(spark, path, newest, load):
        return False
    number = int(newest) + 1
    typed = source.select(*[(F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    one_per_key(typed, keys, dedupe_order, null_safe, keep).write.mode("overwrite").parquet(f"{path}/aside/{load}-rows")
    rows = spark.read.schema(schema).parquet(f"{path}/aside/{load}-rows")
    live = _live(spark, path)
    index = spark.read.parquet(*[f"{path}/index/{name}" for name in _loads(live)])
    _touched(rows, index, live, keys, slots, null_safe).write.mode("overwrite").parquet(f"{path}/aside/{load}-touched")
    touched = spark.read.schema("file string").parquet(f"{path}/aside/{load}-touched")
    again = live.join(touched, "file", "left_semi")
    files = [f"{path}/data/{row.file}" for row in again.select("file").toLocalIterator()]
    target = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    merged = upsert(target, rows, keys, null_safe, update_columns, checked=True) if files else rows
    size = (again.agg(F.sum("n")).first()[0] or 0) + rows.count()
    _write_files(merged, path, load, keys, slots, size, layout["file_rows"])
    _finish(spark, path, load, live.join(touched, "file", "left_anti"), number)
    for name in (f"{load}-rows", f"{load}-touched"):
        versions.remove(spark, f"{path}/aside/{name}")
    return True


def _in_version(spark: SparkSession, path: str, version: str, load: str) -> bool:
    """Whether a version was published by this load whose mark was lost with its driver."""
    files = spark.read.schema("file string, n bigint").parquet(f"{path}/versions/{version}")
    return not files.where(F.col("file").startswith(f"{load}/")).isEmpty()


def drop_old(spark: SparkSession, path: str) -> list[str]:
    """Delete versions before the newest, and loads that no file of it is from; returns the deleted loads.

    Readers of older versions have to be done, and no load may be running.
    """
    *old, newest = _versions(spark, path)
    held = set(_loads(_live(spark, path)))
    gone = sorted(set(versions.names(spark, f"{path}/data")) - held)
    for name in [f"versions/{v}" for v in old] + [f"{kind}/{load}" for load in gone for kind in ("data", "index")]:
        versions.remove(spark, f"{path}/{name}")
    return gone
