"""Writing tables: append, replace, partitioned publish, merge, export, catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.operators.dedupe import dedupe
from bazaar.operators.upsert import one_per_key, upsert

GRAINS = {"DAY": "yyyy-MM-dd", "MONTH": "yyyy-MM", "YEAR": "yyyy"}


def partition_value(moment: Column, grain: str) -> Column:
    """Partition text of a date or timestamp column."""
    return F.date_format(moment, GRAINS[grain])


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_partitioned(
    df: DataFrame, path: str, field: str, grain: str = "DAY", name: str = "part", sort: str | None = None
) -> None:
    """Append, split by a date field.

    Rows are rebalanced on the partition value first, so every partition is
    written by few tasks and AQE still splits a partition that is far larger
    than the others.
    """
    out = df.withColumn(name, partition_value(F.col(field), grain)).hint("rebalance", F.col(name))
    if sort:
        out = out.sortWithinPartitions(F.col(name), F.desc(sort))
    out.write.mode("append").partitionBy(name).parquet(path)


def create_deduped(
    df: DataFrame, path: str, keys: list[str], order: list[str], field: str, grain: str = "DAY"
) -> None:
    """First load: the oldest row per key, partitioned by a date field.

    One row per key is distinct already, so no second pass is made for that.
    """
    append_partitioned(dedupe(df, keys, order, keep="oldest"), path, field, grain)


def insert_select(source: DataFrame, target: T.StructType, mapping: dict[str, str] | None = None) -> DataFrame:
    """Source columns in target order; mapped names apply, absent ones are NULL.

    ``mapping`` is source name to target name. Without it names have to match.
    """
    origin = {new: old for old, new in (mapping or {c: c for c in source.columns}).items()}
    return source.select(
        *[
            (F.col(origin[f.name]) if f.name in origin else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def insert_star(source: DataFrame, target: T.StructType) -> DataFrame:
    """All source columns by name; a differing column set is refused."""
    if set(source.columns) != set(target.fieldNames()):
        raise ValueError(f"columns differ: {sorted(set(source.columns) ^ set(target.fieldNames()))}")
    return insert_select(source, target)


def land_raw_json(df: DataFrame, base: str, run_date: str) -> None:
    df.withColumn("run_date", F.lit(run_date)).write.mode("append").partitionBy("run_date").json(base)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("escape", '"').csv(path, header=True)


def load_report(target: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """One row: rows and columns in the target, and rejected rows."""
    marks = target.select(F.lit(1).alias("loaded"), F.lit(0).alias("rejected"))
    if rejected is not None:
        marks = marks.union(rejected.select(F.lit(0), F.lit(1)))
    return marks.agg(
        F.coalesce(F.sum("loaded"), F.lit(0)).alias("loaded_rows"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected_rows"),
    ).withColumn("loaded_columns", F.lit(len(target.columns)))


def with_reject_reason(df: DataFrame, rules: dict[str, Column], name: str = "reject_reason") -> DataFrame:
    """First broken rule of each row, or NULL. A rule that is NULL counts as broken."""
    reasons = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in rules.items()]
    return df.withColumn(name, F.coalesce(*reasons) if reasons else F.lit(None).cast("string"))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with reason); together they are the input."""
    judged = with_reject_reason(df, rules)
    good = judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, judged.filter(F.col("reject_reason").isNotNull())


def parse_or_reject(df: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Parse JSON text; malformed documents go to the second frame with a reason."""
    with_corrupt = f"{schema}, _corrupt_record string"
    parsed = df.withColumn("doc", F.from_json(F.col(column), with_corrupt, {"mode": "PERMISSIVE"}))
    ok = F.col("doc").isNotNull() & F.col("doc._corrupt_record").isNull()
    good, bad = quarantine(parsed, {"malformed json": ok})
    return good.withColumn("doc", F.col("doc").dropFields("_corrupt_record")), bad.drop("doc")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def list_tables(spark: SparkSession, pattern: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(pattern=pattern)]


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _fs(spark, path)
    return fs.exists(jvm_path)


def merge_into(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: list[str],
    staging: str,
    partition: str | None = None,
    null_safe: bool = True,
    update_columns: list[str] | None = None,
    dedupe_order: list[str] | None = None,
    keep: str = "latest",
) -> bool:
    """Upsert ``source`` into the Parquet table at ``path``; False if already done.

    ``staging`` names this load in the shared folder. The source is stored there
    with one row per key (so it is computed once, and the joins see its real
    size), then the merged rows, so the target is never read and overwritten in
    one job. A load that failed goes on from what it stored, and a published
    load is not repeated: the call can be repeated freely with one staging name.
    Once published, only marks of the load stay below ``staging``.

    With ``partition`` only partitions that the source names or that hold one of
    its keys are rewritten; a partition whose rows all moved away is removed.
    Partition values have the source's type, so texts such as ``007`` stay as
    they are; an empty text becomes NULL, as in every partitioned table.
    """
    rows_at, merged_at, touched_at, done = (f"{staging}/{n}" for n in ("source", "merged", "touched", "published"))
    if _complete(spark, done):
        _remove(spark, rows_at, merged_at, touched_at)
        return False
    if not _complete(spark, rows_at):
        one_per_key(source, keys, dedupe_order, null_safe, keep).write.mode("overwrite").parquet(rows_at)
    rows = spark.read.schema(source.schema).parquet(rows_at)

    if not path_exists(spark, path) or path_exists(spark, f"{staging}/first"):
        _mark(spark, f"{staging}/first")
        _publish(rows, path, partition)
        _mark(spark, done)
        _remove(spark, rows_at)
        return True

    if not _complete(spark, merged_at):
        target = _stored_table(spark, path, partition, source.schema)
        if partition:
            _touched(target, rows, keys, partition, null_safe).write.mode("overwrite").parquet(touched_at)
            target = _in_partitions(target, spark.read.parquet(touched_at), partition)
        upsert(target, rows, keys, null_safe, update_columns, checked=True).write.mode("overwrite").parquet(merged_at)
    merged = spark.read.parquet(merged_at)
    _publish(merged, path, partition)
    if partition:
        _drop_emptied(spark, path, partition, spark.read.parquet(touched_at), merged)
    _mark(spark, done)
    _remove(spark, rows_at, merged_at, touched_at)
    return True


def _stored_table(spark: SparkSession, path: str, partition: str | None, source: T.StructType) -> DataFrame:
    """The table, its partition column in the source's type and not in one guessed from folder names."""
    table = spark.read.parquet(path)
    if not partition:
        return table
    fields = [T.StructField(f.name, source[partition].dataType if f.name == partition else f.dataType) for f in table.schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        jvm_path, fs = _fs(spark, path)
        fs.delete(jvm_path, True)


def _complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def _publish(df: DataFrame, path: str, partition: str | None) -> None:
    """Replace the table, or only the partitions that ``df`` has rows of."""
    if not partition:
        df.write.mode("overwrite").parquet(path)
        return
    df.hint("rebalance", F.col(partition)).write.mode("overwrite").partitionBy(partition).option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def _touched(target: DataFrame, rows: DataFrame, keys: list[str], partition: str, null_safe: bool) -> DataFrame:
    """Partition values the rows name, and those that hold one of their keys now."""
    value = target.schema[partition].dataType
    named = rows.select(F.col(partition).cast(value).alias(partition))
    if partition in keys:  # a key cannot be found in another partition
        return named.distinct()
    holding = target.select(*keys, partition).join(
        rows.select(*keys), _same(keys, target, rows, null_safe), "left_semi"
    )
    return named.union(holding.select(partition)).distinct()


def _in_partitions(target: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """Rows of the touched partitions: folders outside their span are pruned, a semi join picks the rest."""
    value = F.col(partition)
    low, high, nulls = touched.agg(F.min(value), F.max(value), F.bool_or(value.isNull())).first()
    span = F.lit(False) if low is None else value.between(F.lit(low), F.lit(high))
    if nulls:
        span = span | value.isNull()
    return target.filter(span).join(touched, target[partition].eqNullSafe(touched[partition]), "left_semi")


def _same(keys: list[str], target: DataFrame, source: DataFrame, null_safe: bool) -> Column:
    out = F.lit(True)
    for key in keys:
        same = target.schema[key].dataType == source.schema[key].dataType
        a, b = (target[key], source[key]) if same else (target[key].cast("string"), source[key].cast("string"))
        out = out & (a.eqNullSafe(b) if null_safe else a == b)
    return out


def _drop_emptied(spark: SparkSession, path: str, partition: str, touched: DataFrame, staged: DataFrame) -> None:
    """Remove partition folders that kept no row (a handful at most: keys that moved)."""
    left = staged.select(partition).distinct()
    emptied = touched.join(left, touched[partition].eqNullSafe(left[partition]), "left_anti")
    folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for row in emptied.select(F.col(partition).cast("string")).toLocalIterator():
        _remove(spark, f"{path}/{folder(partition, row[0])}")


def _mark(spark: SparkSession, path: str) -> None:
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(path)


def staged_merge(spark: SparkSession, frames: list[DataFrame], target: DataFrame, keys: list[str], order: list[str], keep: str = "oldest") -> DataFrame:
    """All report files of a load, deduped and merged into the target as one lazy plan."""
    from bazaar.sources.reports import union_reports

    return upsert(target, union_reports(*frames), keys, dedupe_order=order, keep=keep)
