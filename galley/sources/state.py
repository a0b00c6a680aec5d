"""The corpus state: paper records in immutable pieces, and a small document that names them.

Records lie in BUCKETS buckets by a hash of their key. ``merge_state`` rewrites the buckets that a batch touches, as new pieces, and then puts a new
document in place of the old one by one atomic rename: a reader or a crash sees the old state or the new one, whole. A piece belongs to one
call (its name is unique), so a batch that runs again never writes over what it reads. Pieces that the last KEEP documents don't name are deleted.

The document also has the totals of each bucket, so those of the state (``load_stats``) need no scan."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley import schemas as S

BUCKETS = 64
KEEP = 3
POINTER = "CURRENT"
TOTALS = ("pages_total", "pages_with_labels", "labels_total")


def _fs(spark: SparkSession, root: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = lambda name: hadoop.Path(f"{root}/{name}")
    return hadoop, at, hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _document(spark: SparkSession, root: str) -> dict | None:
    _, at, fs = _fs(spark, root)
    if not fs.exists(at(POINTER)):
        return None
    return json.loads("\n".join(r.value for r in spark.read.text(f"{root}/{POINTER}").collect()))


def _point(spark: SparkSession, root: str, document: dict) -> None:
    """The document in place of the old one. Rename with overwrite is one step of the file system."""
    hadoop, at, fs = _fs(spark, root)
    new = at(f".{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(document).encode()))
    out.close()
    option = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(option, 1)
    how[0] = option.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(new), fs.makeQualified(at(POINTER)), how)


def _clean(spark: SparkSession, root: str, document: dict) -> None:
    """Delete pieces that none of the last documents names. What a lost call left behind goes with them."""
    hadoop, _, fs = _fs(spark, root)
    live = {piece for names in document["recent"] for piece in names}
    for status in fs.listStatus(hadoop.Path(root)):
        name = status.getPath().getName()
        if name.startswith("piece-") and name not in live:
            fs.delete(status.getPath(), True)


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _write(papers: DataFrame, root: str, key: str, old: dict | None, replaced: list[int] | None, then: Callable[[], None] | None) -> dict:
    """New pieces for the buckets ``replaced`` (None: all), and a document that names them beside the pieces of the others."""
    spark = papers.sparkSession
    piece = f"piece-{uuid.uuid4().hex}"
    papers.withColumn("bucket", _bucket(key)).repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/{piece}")
    written = spark.read.schema(T.StructType([*papers.schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(f"{root}/{piece}")
    good = F.col("status") == "ok" if "status" in papers.columns else F.lit(True)
    counts = [F.count(F.lit(1)).alias("papers_total"), F.count_if(good).alias("papers_ok"), F.count_if(F.col("status") == "failed" if "status" in papers.columns else F.lit(False)).alias("papers_failed")]
    counts += [F.coalesce(F.sum(F.when(good, F.col(c))), F.lit(0)).alias(c) for c in TOTALS if c in papers.columns]
    stats = {str(r.bucket): {k: v for k, v in r.asDict().items() if k != "bucket"} for r in written.groupBy("bucket").agg(*counts).collect()}  # BUCKETS rows at most
    rest = {} if old is None or replaced is None else {b: x for b, x in old["buckets"].items() if int(b) not in replaced}
    buckets = rest | {b: {"piece": piece, "stats": x} for b, x in stats.items()}
    now = sorted({x["piece"] for x in buckets.values()})
    document = {"version": 1, "updated": spark.range(1).select(F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")).first()[0], "buckets": buckets}
    document["recent"] = ([now] + (old["recent"] if old else []))[:KEEP]
    if then is not None:
        then()  # for tests: a crash between writing and pointing
    _point(spark, root, document)
    _clean(spark, root, document)
    return document


def save_state(papers: DataFrame, root: str, key: str = "arxiv_id") -> None:
    """papers as the whole state."""
    _write(papers, root, key, _document(papers.sparkSession, root), None, None)


def merge_state(batch: DataFrame, root: str, schema=None, key: str = "arxiv_id", merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, then: Callable[[], None] | None = None) -> None:
    """The state with a batch merged in; merge(state of the touched buckets, batch) gives their new rows, by default the batch's in place of the
    state's. Only buckets with a key of the batch are read and written. The batch is used more than once."""
    spark = batch.sparkSession
    old = _document(spark, root)
    touched = [r[0] for r in batch.select(_bucket(key).alias("b")).distinct().collect()]  # BUCKETS rows at most
    if not touched:
        return
    state = _read(spark, root, old, schema or batch.schema, touched)
    rows = merge(state, batch) if merge else state.join(batch.select(key), key, "left_anti").select(batch.columns).unionByName(batch)
    _write(rows, root, key, old, touched, then)


def _read(spark: SparkSession, root: str, document: dict | None, schema, buckets: list[int] | None = None) -> DataFrame:
    parts = {} if document is None else {b: x["piece"] for b, x in document["buckets"].items() if buckets is None or int(b) in buckets}
    if not parts:
        return spark.createDataFrame([], schema or S.PAPER)
    paths = [f"{root}/{piece}/bucket={b}" for b, piece in sorted(parts.items())]
    return spark.read.schema(schema).parquet(*paths) if schema is not None else spark.read.parquet(*paths)


def load_state(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """The current state; an empty one where there is none."""
    return _read(spark, root, _document(spark, root), schema)


def load_stats(spark: SparkSession, root: str) -> dict:
    """Totals of the current state, from its document: papers in any status, ok, failed, sums over ok papers, and when it was written."""
    document = _document(spark, root)
    out: dict = {k: 0 for k in ("papers_total", "papers_ok", "papers_failed", *TOTALS)}
    for x in document["buckets"].values() if document else ():
        for k, v in x["stats"].items():
            out[k] += v
    return out | {"last_updated": document["updated"] if document else None}
