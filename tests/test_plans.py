"""Plan guards for every registered query: no Cartesian products or
nested-loop joins, no sort-based aggregation, Python only in the model's
fit/predict steps, and the month filter reaching the readings scan."""

import os

import pytest

from tankflow.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

PYTHON_OK = {"model_fit", "model_predict", "model_forecast", "model_seasonality_mode", "model_gram", "model_fit_check"}
Q = catalog.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def check_plan_shape(name, df):
    """Called by test_oracle.py, which builds each query once for both checks."""
    plan = _plan(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "SortAggregate" not in plan      # every aggregate keeps hash-able buffers
    if name not in PYTHON_OK:
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in plan, node


def test_readings_filter_pushed(spark):
    plan = _plan(Q["hour_minute_bounds"](spark, SF))
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(ts,2024-01-01" in plan


def _final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()


def test_readings_are_not_shuffled_row_by_row(spark):
    """The readings meet the needed minutes by a broadcast, so no exchange stands over a plain scan of them."""
    plan = _final(Q["hourly_tank_outflow"](spark, SF))
    scans = [i for i, x in enumerate(plan.splitlines()) if "events.parquet" in x and "value" in x.split("ReadSchema")[-1]]
    assert scans
    for i in scans:
        above = [x for x in plan.splitlines()[:i][::-1]]
        kinds = ["Exchange" if "Exchange hash" in x else "Join" if "BroadcastHashJoin" in x else "Aggregate" if "HashAggregate" in x
                 else "" for x in above]
        first = next(k for k in kinds if k)
        assert first != "Exchange"


def test_sums_of_the_model_fit_are_one_a_series(spark):
    from tankflow.operators import model as md
    from tankflow.plans.pipeline import Pipeline
    import pyspark.sql.functions as F
    train = md.model_training_frame(Pipeline(spark, SF).history)
    spec = md.ModelSpec()
    grams = md.gram_by_series(md.training_rows(train, md.series_scaling(train, spec), spec))
    assert grams.count() == train.select("station", "product", "tank").distinct().count()
    assert grams.agg(F.sum("n")).first()[0] == train.count()


def test_laid_out_receipts_prune_months_and_join_without_exchange(spark):
    from tankflow.operators.outflow import in_months, receipts_with_items
    _, receipts, items = catalog._laid_out(spark, SF, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _final(receipts_with_items(in_months(receipts, "shift_start", 2024, [1]), items))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "PartitionFilters: [isnotnull(in_month" in plan and "in_month#" in plan.split("PartitionFilters:")[1]


def test_laid_out_readings_prune_months(spark):
    plan = _plan(Q["laid_out_readings"](spark, SF))
    assert "PartitionFilters: [isnotnull(in_month" in plan


def test_lead_lag_deals_readings_out_once(spark, monkeypatch):
    """The windows are satisfied by the range exchange of (series, segment): no second exchange, one sort."""
    from tankflow.operators import windows
    seen = []
    cut = windows.cut_lineage
    monkeypatch.setattr(windows, "cut_lineage", lambda df: seen.append(_plan(df)) or cut(df))
    final = _final(Q["lead_lag_readings"](spark, SF))
    assert "events.parquet" not in final  # the written readings are read, not the source a second time
    assert len(seen) == 1 and seen[0].count("Exchange ") == 1 and seen[0].count("Sort [") == 1


def test_last_rows_of_a_cell_are_limited_before_the_exchange(spark):
    plan = _plan(Q["similar_day_mean"](spark, SF))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
