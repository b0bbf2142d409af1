"""Retry messages as a stream: parse, route, dispatch.

The same DataFrame functions run on a batch or a stream; only the reader and
``foreachBatch`` writers differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaar.sinks import versions

MESSAGE_SCHEMA = (
    "marketplace string, job_type string, page_type string, start_page int, end_page int, "
    "bucket_name string, base_path string, run_date string, target_table string, "
    "schema_path string, retry_count int, category_spec string, shop_spec string"
)
MAX_RETRIES = 3


def read_retry_stream(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """(value, topic): message text of a topic, or of a folder of message files (topic NULL).

    For a topic give ``subscribe``, ``kafka.bootstrap.servers`` and
    ``startingOffsets``; the consumer group is replaced by the query's
    checkpoint. For files use ``fmt="text"`` and ``path``.
    """
    read = spark.readStream.format(fmt).options(**options).load()
    topic = F.col("topic") if "topic" in read.columns else F.lit(None)
    return read.select(F.col("value").cast("string"), topic.cast("string").alias("topic"))


def parse_retry_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Message columns, and the raw text of those that do not parse in ``_corrupt_record``.

    The category and shop specifications stay JSON text. The topic decides the
    kind of job, so it is kept where the input has it.
    """
    schema = f"{MESSAGE_SCHEMA}, _corrupt_record string"
    kept = ["topic"] if "topic" in raw.columns else []
    return raw.select(F.from_json(value, schema, {"mode": "PERMISSIVE"}).alias("m"), *kept).select("m.*", *kept)


def next_retry_count(page: Column, start_page: Column, retry_count: Column, specs: Column | None = None) -> Column:
    """The counter starts over when the failing page is not the message's first
    page, or when the message covers several categories."""
    moved = page != start_page
    if specs is not None:
        moved = moved | F.coalesce(specs > 1, F.lit(False))
    return F.when(moved, 0).otherwise(retry_count)


def route_retries(failures: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Failed pages with their route.

    ``failures`` has the message columns and ``failed_page``. A page whose
    counter is within the limit is sent again alone, counter raised; beyond it
    the message goes to the dead letters unchanged.
    """
    specs = F.json_array_length("category_spec") if "category_spec" in failures.columns else None
    count = next_retry_count(F.col("failed_page"), F.col("start_page"), F.col("retry_count"), specs)
    again = count <= max_retries
    return failures.withColumns(
        {
            "route": F.when(again, "retry").otherwise("dead"),
            "start_page": F.when(again, F.col("failed_page")).otherwise(F.col("start_page")),
            "end_page": F.when(again, F.col("failed_page") + 1).otherwise(F.col("end_page")),
            "retry_count": F.when(again, count + 1).otherwise(F.col("retry_count")),
        }
    )


def write_routes(stream: DataFrame, column: str, sinks: dict[str, str], checkpoint: str, rest: str | None = None) -> StreamingQuery:
    """Rows to one folder per value of a column, everything available, exactly once.

    Rows of any other value, or of none, go to ``rest`` (by default the folder
    of the checkpoint's name with ``-rest``), so no row is lost.

    Each micro-batch is read and written once, split by sink, and its parts are
    moved to the sinks, each to a sub-folder of the batch's number. A batch that
    is run again after a failure replaces them, so a restart repeats no row.
    """
    folders = [*sinks.values(), rest or checkpoint.rstrip("/") + "-rest"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, aside = batch.sparkSession, f"{checkpoint.rstrip('/')}-routed"
        number = F.lit(len(sinks))
        for i, value in enumerate(sinks):
            number = F.when(F.col(column) == value, i).otherwise(number)
        batch.withColumn("_sink", number).write.mode("overwrite").partitionBy("_sink").parquet(aside)
        for i, folder in enumerate(folders):
            part, target = f"{aside}/_sink={i}", f"{folder}/batch={batch_id}"
            if versions.exists(spark, part):
                versions.remove(spark, target)
                versions.move(spark, part, target)
            else:  # no row went there: an empty folder with the columns, so that it can be read
                spark.createDataFrame([], batch.schema).write.mode("overwrite").parquet(target)
        versions.remove(spark, aside)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder; the checkpoint remembers what was read."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
