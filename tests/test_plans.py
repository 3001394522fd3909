"""Shapes of physical plans: tables are compared once, and moved no more than the pairs need."""

import os
import re

import pytest

from sheetwise.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.mark.parametrize("name", ["verify_status", "review_queue", "params_long", "params_last_wins", "params_wide", "category", "importer_rows", "review_params", "review_records", "document_results"])
def test_tables_are_compared_once(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    count = lambda pattern: len(re.findall(pattern, plan))
    # both sides of the join of lines and parts, and the lines of an order
    assert (count(r"FileScan"), count(r"Exchange "), count(r"zip_with\("), count("SortMergeJoin")) == (2, 3, 1, 1)


@pytest.mark.parametrize("name", ["merge_dedup", "merge_confidence", "rule_rows", "title_detect", "num_extract", "standard_headers"])
def test_rows_stay_where_they_are(spark, name):
    assert "Exchange" not in catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_what_is_asked_for(spark):
    plan = catalog.queries()["verify_status"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = {x.split("#")[0]: x.split(",") for x in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)}
    assert {k: len(v) for k, v in scans.items()} == {"l_orderkey": 6, "p_partkey": 3}


def test_cells_are_cleaned_and_headers_named_once_a_row(spark):
    plan = catalog.queries()["rule_rows"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # the ends of a header; white space and the ends of a cell
    assert plan.count("regexp_replace(") == 3 and plan.count("RLIKE") <= 2


@pytest.mark.parametrize("name", ["page_scan", "page_images", "rule_rows"])
def test_tables_of_some_size_are_dealt_to_all_cores(spark, tmp_path, name):
    made = spark.range(100_000).selectExpr("id AS p_partkey", "sha2(cast(id AS string), 256) AS p_name", "'a' AS p_type", "'b' AS p_brand")
    made.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    plan = lambda folder: catalog.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan(tmp_path) and "RoundRobinPartitioning" not in plan(SF)
