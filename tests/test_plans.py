"""Physical plans: one scan, no cross or sort-merge joins, filters and columns that reach the scan."""

import re

import pytest

import __spark_entry__ as driver
from netvigil.registry import QUERIES

BATCH = sorted(name for name in QUERIES if not name.startswith("stream"))


def executed_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_joins(spark, name):
    plan = executed_plan(driver.queries()[name](spark, "/root/testdata/sf0.001"))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan


@pytest.mark.parametrize("name,columns", [
    ("panel_ingest_volume", set()),
    ("panel_critical_count", {"ts", "event_type"}),
    ("panel_severity_timeline", {"ts", "event_type"}),
    ("partition_inventory", {"ts"}),
    ("panel_avg_latency", {"ts", "event_type", "props"}),
])
def test_scans_read_only_what_is_needed(spark, sf_dir, name, columns):
    plan = executed_plan(driver.queries()[name](spark, sf_dir))
    scans = re.findall(r"FileScan parquet \[([^]]*)\]", plan)
    assert {column.split("#")[0] for scan in scans for column in scan.split(",") if column} == columns


@pytest.mark.parametrize("name", ["filter_time_from", "filter_time_closed", "filter_bool", "forecast_points"])
def test_time_filters_reach_the_scan(spark, sf_dir, name):
    assert "GreaterThanOrEqual(ts,2024-01-" in executed_plan(driver.queries()[name](spark, sf_dir))


def test_forecast_partitions_are_pruned(spark, sf_dir):
    plan = executed_plan(driver.queries()["filter_not_wildcard"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[[^]]*Contains\(source_index#\d+, forecast\)", plan)


@pytest.mark.parametrize("name", ["terms_other", "date_histogram_gapfill", "terms_then_date"])
def test_shuffle_is_reused_instead_of_a_second_scan(spark, sf_dir, name):
    assert "ReusedExchange" in executed_plan(driver.queries()[name](spark, sf_dir))


def test_top_per_bucket_is_cut_before_the_shuffle(spark, sf_dir):
    assert "row_number(), 2, Partial" in executed_plan(driver.queries()["date_then_terms_topn"](spark, sf_dir))


def test_a_stored_panel_reads_the_rows_once(spark, sf_dir):
    plan = executed_plan(driver.queries()["panel_severity_timeline_stored"](spark, sf_dir))
    final = plan[plan.index("Final Plan"):].split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1 and "Subquery" not in final


def test_documents_are_parsed_once_for_their_statistics(spark, sf_dir):
    plan = executed_plan(driver.queries()["ingest_stats"](spark, sf_dir))
    final = plan[plan.index("Final Plan"):].split("Initial Plan")[0]
    assert "ReusedExchange" in final and len(re.findall(r"FileScan parquet", final)) == 1
