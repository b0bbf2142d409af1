"""Retry counters kept by the stream itself, one for each work item.

A counter that travels in the message is wrong when a message is lost or sent
twice. Here every work item has its own state: how often it failed, when it
failed last, and which failures were counted. A timer forgets an item some time
after its last failure, so state does not grow for ever.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from bazaar.streaming.retries import MAX_RETRIES

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_AT = "_failed_micros"


#: Counted ids in a page of an item's state; an item of fewer holds them with its counter.
PAGE = 256


class _RetryCounter(StatefulProcessor):
    """Counts the failures of one work item since it was last forgotten.

    An item is read and written once a batch, whatever its failures: every call
    to the state store is a round trip. Ids beyond a page lie in pages by their
    hash, of which a batch reads and writes those that it needs.
    """

    def __init__(self, columns: list[str], max_retries: int, expiry: dt.timedelta):
        self.columns, self.max_retries = columns, max_retries
        self.expiry = expiry // dt.timedelta(microseconds=1)
        self.page = PAGE

    def init(self, handle) -> None:
        self.handle = handle
        self.item = handle.getValueState("item", "n int, last bigint, due bigint, ids array<string>")
        self.more = handle.getMapState("more", "page int", "ids array<string>")
        self.row = Row(*self.columns, "retry_count", "route")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, last, due, ids = self.item.get() or (0, None, None, [])
        before, paged = n, self._pages(n) > 1
        pages, dirty = {} if paged else {0: set(ids)}, set()
        for row in sorted(rows, key=lambda r: (r[_AT], r.failure_id)):
            at = row[_AT]
            if last is not None and at - last > self.expiry:
                n, before, pages, dirty = 0, -1, {0: set()}, set()
                if paged:
                    self.more.clear()
                    paged = False
            page = self._page(pages, row.failure_id, n)
            if row.failure_id in page[1]:
                continue
            page[1].add(row.failure_id)
            dirty.add(page[0])
            if self._pages(n + 1) > self._pages(n):
                every = set().union(*[self._load(pages, p) for p in range(self._pages(n))])
                pages, dirty = {p: set() for p in range(self._pages(n + 1))}, set(range(self._pages(n + 1)))
                for one in every:
                    pages[self._place(one, n + 1)].add(one)
            n += 1
            last = at if last is None else max(last, at)
            yield self.row(*[row[c] for c in self.columns], n, "retry" if n <= self.max_retries else "dead")
        if n != before:
            if due is None:
                due = self._due(last)
                self.handle.registerTimer(due)
            whole = self._pages(n) == 1
            self.item.update((n, last, due, list(pages[0]) if whole else []))
            for p in [] if whole else dirty:
                self.more.updateValue((p,), (list(pages[p]),))

    def _pages(self, n: int) -> int:
        """In how many pages the ids of n failures lie: a power of two."""
        return 1 << (n // self.page).bit_length()

    def _place(self, failure_id: str, n: int) -> int:
        """The page of an id among those of n failures."""
        return zlib.crc32(failure_id.encode()) & (self._pages(n) - 1)

    def _page(self, pages: dict[int, set], failure_id: str, n: int) -> tuple[int, set]:
        p = self._place(failure_id, n)
        return p, self._load(pages, p)

    def _load(self, pages: dict[int, set], p: int) -> set:
        if p not in pages:
            pages[p] = set(self.more.getValue((p,))[0]) if self.more.containsKey((p,)) else set()
        return pages[p]

    def _due(self, last: int) -> int:
        """Milliseconds from which the item is forgotten."""
        return (last + self.expiry) // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Forgets the item, or waits on if it failed again since its timer was set."""
        n, last, _, ids = self.item.get()
        due = self._due(last)
        if due > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(due)
            self.item.update((n, last, due, ids))
        else:
            self.item.clear()
            if self._pages(n) > 1:
                self.more.clear()
        return iter(())

    def close(self) -> None:
        pass


def count_retries(
    failures: DataFrame, keys: list[str], expiry: dt.timedelta, delay: str = "1 hour", max_retries: int = MAX_RETRIES
) -> DataFrame:
    """Every failure of a stream once, with ``retry_count`` and ``route`` (retry or dead).

    ``failures`` has the key columns, ``failure_id`` (text, the same for a message
    that is sent twice) and ``failed_at``. The n-th failure of a work item has
    retry_count n and goes to the dead letters beyond ``max_retries``. An item
    that did not fail for longer than ``expiry`` starts over. Failures that are
    later than ``delay`` are left out, as everywhere with a watermark. Null ids
    are one id; rows without a time are left out. Needs the RocksDB state store
    (``with_rocks``).
    """
    rows = failures.where(F.col("failed_at").isNotNull()).withColumn("failure_id", F.coalesce("failure_id", F.lit("")))
    out = T.StructType([*rows.schema.fields, T.StructField("retry_count", T.IntegerType()), T.StructField("route", T.StringType())])
    return (
        rows.withColumn(_AT, F.unix_micros("failed_at"))
        .withWatermark("failed_at", delay)
        .groupBy(*keys)
        .transformWithState(
            _RetryCounter(rows.columns, max_retries, expiry), outputStructType=out, outputMode="Append", timeMode="EventTime"
        )
    )


def count_retries_batch(failures: DataFrame, keys: list[str], expiry: dt.timedelta, max_retries: int = MAX_RETRIES) -> DataFrame:
    """The same for a whole table: failures in order of time, started over after a gap longer than ``expiry``."""
    rows = failures.where(F.col("failed_at").isNotNull()).withColumn("failure_id", F.coalesce("failure_id", F.lit("")))
    once = rows.dropDuplicates([*keys, "failure_id", "failed_at"])
    order = Window.partitionBy(*keys).orderBy("failed_at", "failure_id")
    gap: Column = F.unix_micros("failed_at") - F.unix_micros(F.lag("failed_at").over(order))
    starts = F.when(gap > expiry // dt.timedelta(microseconds=1), 1).otherwise(0)
    spells = once.withColumn("_starts", starts).withColumn("_spell", F.sum("_starts").over(order))
    spell = Window.partitionBy(*keys, "_spell").orderBy("failed_at", "failure_id")
    counted = spells.withColumn("retry_count", F.row_number().over(spell)).drop("_starts", "_spell")
    return counted.withColumn("route", F.when(F.col("retry_count") <= max_retries, "retry").otherwise("dead"))


class with_rocks:  # noqa: N801
    """The session keeps stream state in RocksDB within this block (queries started there)."""

    KEY = "spark.sql.streaming.stateStore.providerClass"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(self.KEY, None)
        self.spark.conf.set(self.KEY, ROCKS)

    def __exit__(self, *_) -> None:
        if self.before is None:
            self.spark.conf.unset(self.KEY)
        else:
            self.spark.conf.set(self.KEY, self.before)
