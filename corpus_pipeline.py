"""The corpus pipeline: documents in, packed sequences out. Each stage is one operator of galley.llm.

A stage gets what its predecessor kept, written and read again, and all but the last return the
columns of documents. Every stage keeps rows with a null doc_id or text (null counts as the empty text: of several empty texts the
exact stage keeps one), looks at very long texts whole, and takes an empty table and further columns of any name. Of rows that
repeat each other, and in ties, one row stays: that of the largest doc_id in the exact stage, the first in the near-duplicate stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm.decontaminate import drop_contaminated
from galley.llm.exact import exact_dedup
from galley.llm.near import near_dedup
from galley.llm.packing import pack_documents
from galley.llm.queries import CATEGORIES
from galley.llm.scratch import materialize
from galley.llm.toxicity import drop_toxic, fit_chain
from galley.session import make_importable


def _kept(docs: DataFrame, decide: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of docs whose number is among those that decide returns. decide gets docs with a number, and its column's name. The
    numbers are written once, so both sides of the join see the same ones."""
    row = "row"
    while row.lower() in [c.lower() for c in docs.columns]:
        row += "_"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    return numbered.join(decide(numbered, row), row, "left_semi").drop(row)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject."""
    make_importable(spark)
    return drop_toxic(docs, fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), CATEGORIES))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id."""
    make_importable(spark)
    return _kept(docs, lambda rows, row: exact_dedup(rows, row_col=row).filter("kept").select(F.col("row").alias(row)))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    make_importable(spark)
    return _kept(docs, lambda rows, row: near_dedup(rows, id_col=row).filter("kept").select(F.col("doc_id").alias(row)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    make_importable(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths."""
    make_importable(spark)
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontamination), ("packing", packing)]
#: No SQL can express the classifier, the samples or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
