"""Continuous upsert of arriving rows into a Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bazaar.sinks.indexed import merge_indexed
from bazaar.sinks.tables import merge_into


def bounded_dedupe(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def stream_upsert(
    spark: SparkSession,
    stream: DataFrame,
    path: str,
    keys: list[str],
    order: list[str],
    checkpoint: str,
    partition: str | None = None,
    keep: str = "latest",
) -> StreamingQuery:
    """Merge every micro-batch: deduped by key, then upserted.

    Give ``partition`` for a large table: then a batch rewrites only the
    partitions it touches, else the table.

    The batch number names the staging of each merge, so a batch that is run
    again after a failure is finished or skipped, never merged twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_into(
            spark, batch, path, keys, f"{checkpoint}-merges/{batch_id}", partition, dedupe_order=order, keep=keep
        )

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_upsert_indexed(
    spark: SparkSession, stream: DataFrame, path: str, order: list[str], checkpoint: str, keep: str = "latest"
) -> StreamingQuery:
    """Merge every micro-batch into an indexed table: only files that can hold a key of the batch are rewritten.

    The batch number names the load, so a batch that is run again is not merged
    twice; readers see each batch wholly or not at all.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_indexed(spark, batch, path, f"batch-{batch_id}", dedupe_order=order, keep=keep)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
