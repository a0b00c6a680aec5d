import math

import pytest
from pyspark.sql import functions as F

from galley.operators import sampling as P
from galley.operators.histograms import class_weights
from galley.schemas import classes_dim


def pages(spark, pos=60, neg=40):
    rows = [(f"s{i}", f"a{i % 3}", [i % 4, 0]) for i in range(pos)] + [(f"n{i}", f"a{i % 2}", []) for i in range(neg)]
    return spark.createDataFrame(rows, "stem string, archive string, cls array<int>")


@pytest.mark.parametrize("strategy", sorted(P.STRATEGIES))
def test_sizes(spark, strategy):
    df = pages(spark)
    pick = lambda n, r=None: P.sample(df, n, strategy, 1, r)
    assert pick(0).count() == 100 and pick(100).count() == 100 and pick(500).count() == 100
    out = [r.stem for r in pick(30).collect()]
    assert len(out) == len(set(out)) == 30 and all(s[0] == "s" for s in out)
    assert pick(80).count() == 60  # positives are short, and no negatives without a ratio
    mixed = [r.stem for r in pick(40, 0.25).collect()]
    assert sum(s[0] == "n" for s in mixed) == 10 and len(mixed) == 40
    assert sorted(r.stem for r in P.sample(df.repartition(7), 30, strategy, 1).collect()) == sorted(out)  # whatever the partitions


def test_round_robin_takes_turns(spark):
    df = pages(spark, 10, 0).withColumn("archive", F.when(F.col("stem") == "s9", "z").otherwise("a"))
    assert "s9" in {r.stem for r in P.round_robin(df, 2).collect()}


def test_class_balanced_covers_rare_classes(spark):
    rows = [(f"s{i}", "a", [0]) for i in range(200)] + [("rare1", "a", [5]), ("rare2", "a", [6])]
    df = spark.createDataFrame(rows, "stem string, archive string, cls array<int>")
    assert {"rare1", "rare2"} <= {r.stem for r in P.class_balanced(df, 6).collect()}


def test_negative_cap(spark):
    df = pages(spark)
    assert P.cap_negatives(df, 0.2).filter("size(cls) = 0").count() == round(60 / 0.8 * 0.2)
    for ratio in (None, 0.0, 1.0, 0.9):
        assert P.cap_negatives(df, ratio).count() == 100
    assert P.cap_negatives(pages(spark, 0, 5), 0.2).count() == 5
    assert P.budgets(10, 3, 0.25) == (8, 2) and P.budgets(10, 1, 0.9) == (9, 1) and P.budgets(10, 9, None) == (10, 0)
    assert [r.stem[0] for r in P.preview(pages(spark, 3, 40), 10).collect()].count("s") == 3


def test_rarity(spark):
    got = {r.stem: r.rarity for r in P.rarity(P.positives(pages(spark, 4, 1))).collect()}
    assert math.isclose(got["s0"], 2 / 5, abs_tol=1e-9) and math.isclose(got["s1"], 1 + 1 / 5, abs_tol=1e-9)
    with pytest.raises(ValueError):
        P.sample(pages(spark), 5, "other")


def test_class_weights(spark):
    counts = spark.createDataFrame([(0, 100), (1, 3), (2, 99)], "cls int, n bigint")
    got = {r.kind: r.weight for r in class_weights(counts, classes_dim(spark)).collect()}
    assert (got["figure"], got["figure_cap"], got["table"], got["listing"]) == (1.0, 30.0, 1.01, 30.0)
