"""Samples of page candidates. Input: stem, archive, cls (array of the classes on the page; empty: a negative).

Random order is the order of SHA-256 over the seed and the key, so a sample depends on data and
seed alone, not on partitions. Samples may be as large as the corpus, so none is a global sort with a limit: ``first_of`` looks up
where the n-th row lies by counts of hash prefixes, and only rows of that one prefix are ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled(key: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}|"), key.cast("string")), 256)


def positives(pages: DataFrame) -> DataFrame:
    return pages.filter(F.size("cls") > 0)


def negatives(pages: DataFrame) -> DataFrame:
    return pages.filter(F.size("cls") == 0)


def first_of(rows: DataFrame, n: int, order: Column, *ties: str, turn: Column | None = None) -> DataFrame:
    """The first n rows by (turn, order, ties); order is a hash in hex. Counts by turn and the first four digits say which of these cells hold
    the boundary; whole cells before it pass by a filter, and the cell at it, one in 65,536 of a turn, is sorted."""
    if n <= 0:
        return rows.limit(0)
    keyed = rows.withColumns({"_turn": turn if turn is not None else F.lit(0), "_hash": order}).withColumn("_cell", F.left("_hash", F.lit(4)))
    before = Window.orderBy("_turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = keyed.groupBy("_turn").agg(F.count(F.lit(1)).alias("_n"))
    # a turn has at most one row of each archive, or there is one turn: the table of turns is as long as the largest archive's share of a sample
    at = turns.withColumn("_past", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter((F.col("_past") < n) & (F.col("_past") + F.col("_n") >= n)).first()
    if at is None:  # fewer than n rows
        return rows
    inside = keyed.filter(F.col("_turn") == at["_turn"])
    cells = inside.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))  # at most 65,536 rows
    past = F.coalesce(F.sum("_n").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.lit(at["_past"])
    cell = cells.withColumn("_past", past).filter((F.col("_past") < n) & (F.col("_past") + F.col("_n") >= n)).first()
    whole = keyed.filter((F.col("_turn") < at["_turn"]) | ((F.col("_turn") == at["_turn"]) & (F.col("_cell") < cell["_cell"])))
    rest = inside.filter(F.col("_cell") == cell["_cell"]).orderBy("_hash", *ties).limit(n - cell["_past"])
    return whole.unionByName(rest).drop("_turn", "_hash", "_cell")


def random_sample(pages: DataFrame, n: int, seed: int = 0) -> DataFrame:
    return first_of(pages, n, shuffled(F.col("stem"), seed), "stem")


def round_robin(pages: DataFrame, n: int, seed: int = 0, first: list[Column] | None = None) -> DataFrame:
    """n pages taken from the archives in turn; ``first`` orders pages inside an archive before the hash."""
    w = Window.partitionBy("archive").orderBy(*(first or []), shuffled(F.col("stem"), seed), "stem")
    ranked = pages.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n)
    return first_of(ranked, n, shuffled(F.col("archive"), seed), "archive", turn=F.col("_rank")).drop("_rank")


def class_frequency(pages: DataFrame) -> DataFrame:
    """(cls, freq) over the labels of positive pages."""
    return pages.select(F.explode("cls").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("freq")).select(F.col("c").alias("k"), "freq")


def rarity(pages: DataFrame) -> DataFrame:
    """(stem, rarity): the sum of 1 / frequency over a page's labels, to nine places."""
    labels = pages.select("stem", F.explode("cls").alias("k"))
    # one row a class: the classes of a dataset are few and fixed
    return labels.join(F.broadcast(class_frequency(pages)), "k").groupBy("stem").agg(F.round(F.sum(F.lit(1.0) / F.greatest(F.lit(1), F.col("freq"))), 9).alias("rarity"))


def balanced(pages: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Round-robin over archives, pages with rare classes first."""
    scored = pages.join(rarity(pages), "stem")
    return round_robin(scored, n, seed, [F.desc("rarity")]).drop("rarity")


def class_balanced(pages: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Round-robin over classes, each page once: a page's turn is its least rank among the pages of one of its classes, in the order of a hash, and
    inside a turn the classes come in the order of a hash. A page that two classes would take in one turn is taken by the first; the second
    waits for its next turn, where a greedy pass would let it take another page at once."""
    ranked = pages.select("stem", F.explode(F.array_distinct("cls")).alias("k")).withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(shuffled(F.col("stem"), seed), "stem")))
    turn = ranked.filter(F.col("r") <= n).groupBy("stem").agg(F.min(F.struct("r", shuffled(F.col("k"), seed).alias("ko"))).alias("t")).select("stem", F.col("t.r").alias("r"), F.col("t.ko").alias("ko"))
    return pages.join(first_of(turn, n, F.col("ko"), "stem", turn=F.col("r")).select("stem"), "stem", "left_semi")


def budgets(n: int, negative_pages: int, ratio: float | None) -> tuple[int, int]:
    """How many positive and negative pages a sample of n asks for. Python's round: ties to even."""
    if ratio is None:
        return n, 0
    want = min(negative_pages, round(n * ratio))
    return n - want, want


def negative_target(positive_pages: int, ratio: float) -> int:
    return round(positive_pages / max(1e-6, 1.0 - ratio) * ratio)


def cap_negatives(pages: DataFrame, ratio: float | None, seed: int = 0) -> DataFrame:
    """All positives, and negatives thinned to ``ratio`` of the result; as it is where that is no number
    in (0, 1), either kind is missing, or negatives are few enough."""
    if ratio is None or not 0 < ratio < 1:
        return pages
    pos, neg = pages.agg(F.count_if(F.size("cls") > 0), F.count_if(F.size("cls") == 0)).first()
    target = negative_target(pos, ratio)
    if not pos or not neg or target >= neg:
        return pages
    return positives(pages).unionByName(random_sample(negatives(pages), target, seed))


STRATEGIES = {"random": random_sample, "by-archive": round_robin, "balanced": balanced, "class-balanced": class_balanced}


def sample(pages: DataFrame, n: int, strategy: str = "balanced", seed: int = 0, ratio: float | None = None) -> DataFrame:
    """At most n pages. Without a ratio no negatives are taken, even if positives are short."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    total, neg = pages.agg(F.count(F.lit(1)), F.count_if(F.size("cls") == 0)).first()
    if n <= 0 or n >= total:
        return pages
    want_pos, want_neg = budgets(n, neg, ratio)
    out = STRATEGIES[strategy](positives(pages), want_pos, seed)
    return out.unionByName(round_robin(negatives(pages), want_neg, seed).select(out.columns)) if want_neg else out


def export_sample(pages: DataFrame, n: int, strategy: str = "balanced", seed: int = 0, ratio: float | None = None) -> DataFrame:
    """A sample where n is below the number of pages, else all pages with negatives capped."""
    if 0 < n < pages.count():
        return sample(pages, n, strategy, seed, ratio)
    return cap_negatives(pages, ratio, seed)


def preview(pages: DataFrame, n: int = 16, seed: int = 0) -> DataFrame:
    """n pages for a mosaic, positives first."""
    return pages.orderBy(F.size("cls") == 0, shuffled(F.col("stem"), seed), "stem").limit(n)
