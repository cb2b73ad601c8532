"""Plan properties the scale design relies on (checked with explain output)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_window_is_pushed_and_pruned(spark):
    p = _plan(spark, "prediction_volume_daily")
    assert "GreaterThanOrEqual(ts,2024-01-17T00:00)" in p
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz>", p)


@pytest.mark.parametrize("name", ["drift_feature_distances", "kpi_summary", "validation_profile",
                                  "evaluation_metrics", "run_history", "promotion_ledger",
                                  "stratified_split", "term_stats"])
def test_no_cartesian_or_nested_loop_joins(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_drift_has_no_range_join_and_scans_events_once(spark):
    p = _plan(spark, "drift_feature_distances")
    assert "SortMergeJoin" not in p
    assert p.count("FileScan parquet") == 1


@pytest.mark.parametrize("name", ["stratified_split", "reference_profile"])
def test_split_decides_every_row_where_it_is(spark, name):
    # cutoffs come from counts, written before; no window is left over the rows
    assert "Window" not in _plan(spark, name)
    df = E.queries()[name](spark, SF)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    # no text below a window or a shuffled aggregate
    for line in optimized.splitlines():
        assert not re.search(r"(Window|Aggregate|Repartition).*\btext#", line)


def test_top_runs_use_group_limit(spark):
    assert "WindowGroupLimit" in _plan(spark, "experiment_runs")


@pytest.mark.parametrize("name", ["clean_documents", "clean_pages", "clean_conversations"])
def test_cleaning_runs_no_python(spark, name):
    p = _plan(spark, name)
    assert "EvalPython" not in p and "InArrow" not in p and "InPandas" not in p
