"""Catalogue pages: structured data joined with item cards, and detail work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions import html as H
from bazaar.functions.nested import explode_rows
from bazaar.functions.text import segment
from bazaar.operators.dedupe import first_by_ordinal
from bazaar.operators.joins import left_join_fanout


def products(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """One row per JSON-LD product of a page; scripts without an id are left out."""
    schema = (
        "productID string, name string, url string, "
        "offers struct<price string, lowPrice string, highPrice string>, "
        "aggregateRating struct<ratingValue string, ratingCount string>"
    )
    scripts = explode_rows(pages, H.ld_json(F.col(html)), keep, "script", "ordinal")
    docs = scripts.withColumn("doc", F.from_json("script", schema)).filter(F.col("doc.productID").isNotNull())
    number = lambda c: F.col(c).try_cast("double")
    return docs.select(
        *keep,
        "ordinal",
        F.col("doc.productID").alias("productid"),
        F.col("doc.name").alias("name"),
        F.col("doc.url").alias("url"),
        segment(F.col("doc.url"), -2, ".").alias("storeid"),
        number("doc.offers.price").alias("offers_price"),
        number("doc.aggregateRating.ratingValue").alias("aggregaterating_ratingvalue"),
    )


def cards(pages: DataFrame, keep: list[str], blocks: Column, fields: dict[str, Column]) -> DataFrame:
    """One row per repeated item block; ``fields`` read the column ``block``."""
    rows = explode_rows(pages, blocks, keep, "block", "card")
    return rows.select(*keep, "card", *[c.alias(n) for n, c in fields.items()])


def catalogue_join(product_rows: DataFrame, card_rows: DataFrame, keys: list[str], unique: list[str]) -> DataFrame:
    """Products with their card fields, first one of every ``unique`` key kept."""
    joined = left_join_fanout(product_rows, card_rows, keys)
    ordered = joined.withColumn("_at", F.struct("ordinal", F.coalesce(F.col("card"), F.lit(-1))))
    return first_by_ordinal(ordered, unique, "_at").drop("_at", "card")


def detail_worklist(headers: DataFrame, url: str, run_date: Column) -> DataFrame:
    """Distinct non-null URLs of one run date."""
    return headers.filter(run_date).select(url).dropna().distinct()
