"""Files that are no longer needed leave the disk while a job still runs."""

import os
import time

from pyspark.sql import functions as F

from bazaar.llm import components
from bazaar.llm.storage import release, stored


def shuffles(spark):
    """Numbers of the shuffles that have files on the session's disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    names = [name for folder in folders for _, _, files in os.walk(folder) for name in files]
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def left_over(spark, before, most):
    """Shuffles that came after ``before``, once there are ``most`` or five seconds have gone."""
    for _ in range(50):
        if len(left := shuffles(spark) - before) <= most:
            break
        time.sleep(0.1)
    return left


def test_release_deletes_tables_and_shuffle_files(spark):
    before = shuffles(spark)
    table = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n")), "released")
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file://"))
    assert table.count() == 7 and os.path.isdir(folder) and shuffles(spark) - before
    release(spark, table)
    assert not left_over(spark, before, 0) and not os.path.exists(folder)


def test_rounds_of_components_leave_no_shuffle_files(spark):
    edges = [(i, i + 1) for i in range(40)]
    before = shuffles(spark)
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert len(left_over(spark, before, 1)) <= 1  # of the last look for changes
    assert {(r.id, r.root) for r in found.collect()} == {(i, 0) for i in range(41)}
