"""Physical-plan checks: pushdown, one window, no pair-producing joins."""

import pytest

from conftest import SF001, plan_text
from txrisk.plans import catalog
from txrisk.plans.catalog import ROWS_ONLY


def _plan(df):
    """The final adaptive plan (the text after 'Final Plan', before 'Initial Plan')."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(ROWS_ONLY)))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(catalog.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_velocity_uses_one_window_over_preaggregate(spark):
    df = catalog.queries()["dest_velocity"](spark, SF001)
    plan = _plan(df)
    assert plan.count("Window [") == 1
    assert "PushedFilters: [In(event_type, [click,purchase])]" in plan


def test_scan_reads_only_needed_columns(spark):
    df = catalog.queries()["activity_by_step"](spark, SF001)
    plan = _plan(df)
    # user_id and props are not needed for per-step counts
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan


# A test-split or slice query reads only the row groups of its steps.
STEP_PRUNED = ["slice_view", "slice_summary", "class_weight", "type_index", "confusion_rule", "confusion_cells",
               "prf_rule", "auc_amount", "rule_baseline_test", "rule_false_negatives", "rule_false_positives",
               "rule_metrics_by_band", "threshold_costs_amount", "best_threshold_amount"]


@pytest.mark.parametrize("name", STEP_PRUNED)
def test_step_range_reaches_the_scan(spark, name):
    df = catalog.queries()[name](spark, SF001)
    pushed = plan_text(df).split("PushedFilters: ")[1].split("\n")[0]
    assert "GreaterThanOrEqual(ts," in pushed or "LessThan(ts," in pushed


def test_first_errors_are_a_top_n(spark):
    assert "TakeOrderedAndProject" in _plan(catalog.queries()["rule_false_negatives_top"](spark, SF001))


def test_train_preparation_scans_events_twice_at_most(spark):
    from txrisk.operators import model as ML
    from txrisk.plans import stages

    train = stages.enriched_from_dir(spark, SF001, step_hi=600)
    assert plan_text(ML.model_inputs(train)).count("Scan parquet") // 2 <= 2
    prepared = plan_text(ML.prepare_train(train))
    assert "events.parquet" not in prepared and "Window" not in prepared
