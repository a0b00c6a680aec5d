"""Sessions with the settings that the library expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did. On a cluster the same path,
    or --py-files, has to provide it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


#: With it at false, a join on the paper and more takes both sides as they lie, dealt by paper, and doesn't deal them again by all of its keys.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def join_as_dealt(spark: SparkSession, on: bool = True) -> None:
    """Sets CO_PARTITION for the relations of papers, or back to Spark's default. Results don't depend on it, only exchanges."""
    spark.conf.set(CO_PARTITION, str(not on).lower())


def get_session(app: str = "galley", cores: int | None = None, **conf: str) -> SparkSession:
    """The active session, or a local one. On a cluster pass nothing: spark-submit's settings hold."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if "SPARK_MASTER" not in os.environ:
        builder = builder.master(f"local[{cores or '*'}]")
    defaults = {
        "spark.sql.shuffle.partitions": str(cores or 8),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        CO_PARTITION: "false",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    return builder.config(map=defaults | conf).getOrCreate()
