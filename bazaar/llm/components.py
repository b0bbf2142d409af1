"""Connected components of a link table, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.storage import release, stored


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``root`` (smallest id of the component) for every id in links (a, b).

    Alternates between linking the larger neighbours and the smaller neighbours
    of every node to its smallest one until nothing changes. Each round is a
    grouping (with partial sums) and an equi-join whose hot side Spark can
    split; the rounds are logarithmic in the size of a component. A round's
    tables and shuffle files go before the next. Links with a null end or from a
    node to itself are left out.
    """
    spark = links.sparkSession
    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Not made distinct: these are no more rows than the links, and the smaller ones are made so below.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        new = stored(small.where("u <> v").distinct(), "edges")
        release(spark, edges, large)
        edges = new
        ends = edges.select("u", F.lit(1).alias("down"), F.lit(0).alias("up"))
        ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
        sums = ends.groupBy("u").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        if sums.where("down + up > 1").isEmpty():  # every node points at one root, no root points on
            break
    root = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return root.union(root.select(F.col("root").alias("id"), "root").distinct())
