"""How rows are dealt over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_paper(rows: DataFrame) -> DataFrame:
    """Rows with those of a paper in one partition. Spark drops the exchange where they lie so already; what then goes by paper
    and anything else needs none."""
    return rows.repartition("paper_id")
