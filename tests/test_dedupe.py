from galley.sources import catalog


def test_dedupe_makes_one_list_for_an_id(spark):
    rows = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "x", None), ("b", "y", 3)], "arxiv_id string, queried_archive string, arrival long")
    out = catalog.dedupe(rows)
    assert {r.arxiv_id: (r.queried_archive, r.arrival, list(r.also_in_archives)) for r in out.collect()} == {"a": ("y", 1, ["y", "x"]), "b": ("x", None, ["x", "y"])}
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
