"""Relations of papers are dealt by paper once."""

import re

import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"


def exchanges(spark, name):
    """The keys of all exchanges of rows, but those of a fixed number of groups."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)


@pytest.mark.parametrize("name", ["cap_body_union", "clip_filter", "coco_annotations", "wrap_resolve", "span_resolve", "fallback_pair_join", "golden_diff", "export_candidates", "coco_fingerprint"])
def test_rows_are_dealt_by_paper_alone(spark, name):
    keys = exchanges(spark, name)
    assert keys and all(re.fullmatch(r"paper_id#\d+L", k) for k in keys), keys


def test_other_queries_keep_the_default(spark):
    entry._ready(lambda s, d: s.range(1), False)(spark, DIR)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    entry._ready(lambda s, d: s.range(1), True)(spark, DIR)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"


def test_files_are_dealt_by_paper_once(spark):
    """Main files are found and flattened where the files of a paper lie: no second exchange, no join of papers one by one."""
    assert [re.sub(r"#\d+", "", k) for k in exchanges(spark, "tex_flattened")] == ["paper_idL"]
    plan = entry.queries()["tex_flattened"](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "MapInArrow" in plan
