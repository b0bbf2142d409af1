"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partition counts are left to the
# cluster: AQE coalesces small ones and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(app: str = "bazaar", cores: str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    options = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": os.path.join(tempfile.gettempdir(), "bazaar-warehouse"),
        **extra,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Make a given session use the time zone the results are stated in."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_own_root: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent (tests, a laptop) is a temporary folder
    made, one per application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir: the executors of a cluster need a folder that all of them see")
    application = spark.sparkContext.applicationId
    if application not in _own_root:
        _own_root[application] = tempfile.mkdtemp(prefix="bazaar-")
    return _own_root[application]


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    return f"{shared_root(spark)}/bazaar/{label}-{uuid.uuid4().hex}"
