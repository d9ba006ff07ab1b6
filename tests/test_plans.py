"""Physical plans: joins without cross products, pruned scans, one wide shuffle."""

import re

import pytest

from cellwatch.operators import confirm
from cellwatch.plans import driver_tables as dt
from cellwatch.plans import risk
from cellwatch.registry import QUERIES, days, inputs, windows

SF = "/root/testdata/sf0.001"
RUNS_JOBS = ("stream", "incremental", "append", "upsert", "job")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not q.startswith(RUNS_JOBS)))
def test_no_cross_products(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_confirmation_shuffles_and_sorts_once(spark):
    plan = plan_of(days.walked(spark, SF))
    # One for the rows, and one that makes the dimension unique.
    assert len(re.findall(r"Exchange hashpartitioning\(h3_cell", plan)) == 2
    above = plan[: plan.index("Exchange hashpartitioning(h3_cell")]
    assert above.count("Window ") == 3 and above.count("Sort [") == 1


def test_last_write_is_reduced_before_the_shuffle(spark):
    plan = plan_of(confirm.daily_outcomes(days.walked(spark, SF)))
    assert plan.count("WindowGroupLimit") == 2


def test_windows_aggregate_before_the_shuffle(spark):
    plan = plan_of(windows.cell_windows(spark, SF))
    assert plan.count("HashAggregate(keys=[h3_cell#") + plan.count("HashAggregate ") >= 2 and "SortAggregate" not in plan


def test_scans_are_pruned_and_filtered(spark):
    plan = plan_of(dt.sensors(dt.events(spark, SF)).select("h3_cell", "co2"))
    assert "EqualTo(event_type,error)" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan


def test_cells_to_cut_are_found_without_scoring(spark):
    ev = dt.events(spark, SF)
    plan = plan_of(dt.job(spark, SF).pairs(dt.weather(ev), dt.sensors(ev), dt.fires(ev)))
    assert "EXP(" not in plan and "Join" not in plan


def test_predictions_read_the_events_once_per_topic(spark, monkeypatch):
    """Three topics are three scans; everything after reads what they were written to."""
    plans = []
    write = risk.materialise

    def seen(df, name):
        plans.append(plan_of(df))
        return write(df, name)

    monkeypatch.setattr(risk, "materialise", seen)
    plans.append(plan_of(days.all_predictions(spark, SF)))
    assert sum(p.count("events.parquet") for p in plans) == 3
    assert sum(p.count("EXP(") > 0 for p in plans if "events.parquet" in p) == 1


def test_payload_stays_in_the_row(spark):
    assert "Exchange" not in plan_of(windows.payload_flatten(spark, SF))


def test_dimension_is_joined_to_windows_not_to_events(spark):
    plan = plan_of(windows.cell_windows(spark, SF))
    assert plan.index("Join") < plan.index("HashAggregate")


def test_points_are_not_paired_and_regrouped(spark):
    plan = plan_of(inputs.nearest_cell(spark, SF))
    above = plan[: plan.index("array_min")]
    assert "Aggregate" not in above and "Generate" not in above
