"""The physical plans the queries are meant to have."""

import pytest

import __spark_entry__ as entry
from conftest import DATA, plan_of

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups")
# Queries of the optional subpackage are tested beside it.
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}


@pytest.fixture(scope="module")
def plan(spark):
    return lambda name: plan_of(QUERIES[name](spark, DATA))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_no_cross_joins(plan, name):
    text = plan(name)
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top5_keeps_five_rows_per_group_before_the_shuffle(plan):
    text = plan("mrt_top5_sector_daily")
    assert "row_number(), 5, Partial" in text and "row_number(), 5, Final" in text


def test_first_of_key_drops_copies_before_the_shuffle(plan):
    assert "row_number(), 1, Partial" in plan("dedup_ticks")


def test_daily_stats_use_one_hash_aggregation(plan):
    text = plan("int_daily_stock_stats")
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert text.count("Exchange") == 2


def test_fact_broadcasts_both_dimensions(plan):
    assert "SortMergeJoin" not in plan("fct_intraday_ticks")


def test_recent_queries_push_their_time_filter_to_the_scan(plan):
    for name in ("stg_ticks_14d", "mrt_volume_anomalies", "top_gainers_today", "dq_stale"):
        assert "GreaterThanOrEqual(ts" in plan(name), name


def test_anomalies_scan_once(plan):
    assert plan("mrt_volume_anomalies").count("FileScan") == 1


def test_high_water_levels_share_their_shuffle(spark):
    result = QUERIES["high_water_mark_dedup"](spark, DATA)
    result.collect()
    assert "ReusedExchange" in plan_of(result)


def test_quality_log_scans_once(plan):
    assert plan("dq_all_checks").count("FileScan") == 1


def test_global_top_k_needs_no_full_sort(plan):
    assert "TakeOrderedAndProject" in plan("top_gainers_today")


def test_scans_read_only_needed_columns(plan):
    text = plan("ticks_per_minute")
    schema = text[text.index("ReadSchema") :].split("\n")[0]
    assert "props" not in schema and "value" not in schema


@pytest.mark.parametrize("name", ["dim_ticker", "dim_sector"])
def test_dimension_rows_are_not_gathered_in_one_task(plan, name):
    assert "SinglePartition" not in plan(name)
