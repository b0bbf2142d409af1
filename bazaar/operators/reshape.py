"""Aggregation and reshape of metric reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sum_by(df: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """Sums of ``{output: input}`` per key tuple."""
    return df.groupBy(*keys).agg(*[F.sum(src).alias(out) for out, src in measures.items()])


def array_by(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Sorted array of the distinct values per key.

    Meant for values with a small domain (days of a requested range, event
    kinds): the domain, not the number of rows, bounds the array, because
    distinct values are formed before the shuffle.
    """
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(out))


def unpivot(df: DataFrame, keys: list[str], measures: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(keys, measures, name, value)


def pivot_metrics(
    df: DataFrame,
    keys: list[str],
    identifier: str,
    value: str,
    known: list[str],
    renames: dict[str, str] | None = None,
    scaled: dict[str, float] | None = None,
    whole: list[str] = (),
) -> DataFrame:
    """Key-value metrics to one wide row per key; unknown identifiers are ignored.

    Written as conditional aggregates, so it is one partial and one final
    aggregate and never a second pass to find the identifiers. ``scaled`` gives
    a factor per identifier, ``whole`` lists those cut to integers. A repeated
    identifier gives its largest value.
    """
    renames, scaled = renames or {}, scaled or {}
    columns = []
    for name in known:
        metric = F.max(F.when(F.col(identifier) == name, F.col(value) * F.lit(scaled.get(name, 1.0))))
        columns.append((metric.cast("bigint") if name in whole else metric).alias(renames.get(name, name)))
    return df.groupBy(*keys).agg(*columns)


def offset_matrix(
    df: DataFrame, keys: list[str], tokens: Column, layout: dict[str, int], columns: list[str]
) -> DataFrame:
    """Ordered token list to a metric matrix: one row per metric.

    ``layout`` gives the position of a metric's first token; the following ones
    fill ``columns`` in order. Positions beyond the end are NULL. Narrow: every
    list is read within its own row.
    """
    listed = df.select(*keys, tokens.alias("_tokens"))
    rows = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                *[
                    F.try_element_at(F.col("_tokens"), F.lit(start + i + 1)).alias(c)
                    for i, c in enumerate(columns)
                ],
            )
            for metric, start in layout.items()
        ]
    )
    return listed.select(*keys, F.inline(rows))


# Positions of the account health metrics in the printed page.
HEALTH_COLUMNS = ["toko_saya", "target", "periode_sebelumnya", "poin_penalti", "aksi"]
HEALTH_SECTIONS = {
    6: [
        "pelanggaran_produk_berat",
        "produk_spam",
        "produk_imitasi",
        "produk_yang_dilarang",
        "produk_pre_order",
        "jumlah_hari_dari_pelanggan_produk_pre_order",
        "pelanggaran_produk_ringan",
    ],
    47: [
        "tingkat_pesanan_tidak_terselesaikan",
        "tingkat_pembatalan",
        "tingkat_pengembalian",
        "tingkat_keterlambatan_pengiriman_pesanan",
        "masa_pengemasan",
    ],
    78: ["persentase_chat_dibalas", "kecepatan_chat_dibalas"],
    94: ["keseluruhan_penilaian"],
}


def health_layout() -> dict[str, int]:
    """Metric name to position: each section is a run of five-token rows."""
    return {
        metric: start + i * len(HEALTH_COLUMNS)
        for start, metrics in HEALTH_SECTIONS.items()
        for i, metric in enumerate(metrics)
    }


def joined_set(df: DataFrame, keys: list[str], value: str, out: str, sep: str = " , ") -> DataFrame:
    """Distinct values per owner as one separated text (see ``array_by`` for its bound)."""
    return array_by(df, keys, value, out).withColumn(out, F.array_join(out, sep))


def paged_set(df: DataFrame, owner: str, value: str, size: int = 1000, buckets: int = 256) -> DataFrame:
    """Distinct values per owner as pages: (owner, page, values), ``size`` values in a page, fewer in the last one.

    An owner may have any number of values. They are numbered within buckets
    of their hash, so that no task holds an owner's set; the sizes of an owner's
    buckets (one row each) give every bucket its first number. Values stand in
    order of bucket, then value. NULL values are left out; a NULL owner is one.
    """
    edges = df.where(F.col(value).isNotNull()).select(F.col(owner).alias("owner"), F.col(value).alias("value")).distinct()
    edges = edges.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    numbered = edges.withColumn("at", F.row_number().over(Window.partitionBy("owner", "bucket").orderBy("value")))
    sizes = edges.groupBy("owner", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("owner").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("owner").alias("of"), F.col("bucket").alias("of_bucket"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    same = F.col("owner").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("of_bucket"))
    number = F.col("start") + F.col("at") - 1
    placed = numbered.join(starts, same).select("owner", F.floor(number / size).alias("page"), F.struct("bucket", "value").alias("x"))
    pages = placed.groupBy("owner", "page").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return pages.select(F.col("owner").alias(owner), "page", F.transform("xs", lambda x: x["value"]).alias("values"))
