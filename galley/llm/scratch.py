"""Tables written to the folder that all executors share, in place of long lineages.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Where that is unset, a session whose master is
local (tests, notebooks) gets a temporary one; on a cluster that is an error, as executors couldn't see it.
Tables go when they are dropped, or when the Python process ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group: a writer holds one in memory, and texts in full fill it.
ROW_GROUP = 32 << 20
_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, or a folder of our own where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="galley-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _drop_all() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session may have ended first
            pass


atexit.register(_drop_all)


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there and a lost
    executor costs only its own tasks."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/galley-{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete tables of materialize() that nothing lazy reads any more."""
    for df in tables:
        for entry in [e for e in _made if any(e[1] in f for f in df.inputFiles()[:1])]:
            _made.remove(entry)
            _delete(*entry)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
