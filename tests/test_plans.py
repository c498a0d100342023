"""Plan-shape regression tests: the properties PLANS.md documents."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from shoreline.plans import catalog

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


def exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange\b", plan)) - len(re.findall(r"\bBroadcastExchange\b", plan))


@pytest.mark.parametrize("name", ["latest_temperature", "sun_hour", "beach_hour_filtered"])
def test_latest_and_table_joins_are_one_partially_aggregated_exchange(spark, name):
    plan = final_plan(entry.queries()[name](spark, SF))
    assert exchanges(plan) == 1
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
    assert "partial_max_by" in plan


def test_beach_day_shuffles_and_no_static_broadcast(spark):
    plan = final_plan(entry.queries()["beach_day"](spark, SF))
    assert exchanges(plan) <= 3
    assert "BroadcastExchange" not in plan          # sun table only on measured size


@pytest.mark.parametrize("name", [n for n in catalog.queries() if not n.startswith("stream_")])
def test_batch_queries_run_without_python_evaluation(spark, name):
    plan = final_plan(entry.queries()[name](spark, SF))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in plan, op


def test_week_calendar_filters_reach_the_scans(spark):
    plan = final_plan(entry.queries()["calendar_week"](spark, SF))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert len(pushed) >= 2 and all("GreaterThanOrEqual(ts" in p and "LessThan(ts" in p for p in pushed)


def test_week_filters_reach_the_scans_of_five_logs(spark):
    from shoreline.plans.served_queries import five_logs

    plan = final_plan(five_logs(spark, SF).beach_hour(days=("2024-01-08", "2024-01-15")))
    pushed = re.findall(r"PushedFilters: [^\n]*", plan)  # long lists are cut, without a bracket
    assert len(pushed) == 5 and all("GreaterThanOrEqual(hora" in p for p in pushed)


def test_served_week_view_prunes_day_directories(spark):
    plan = final_plan(entry.queries()["served_calendar_week"](spark, SF))
    parts = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("dia" in p and ">=" in p and "<" in p for p in parts)
    assert "PushedFilters: [" in plan and "EqualTo(local,Ubatuba)" in plan


def test_a_served_table_is_written_once(spark, tmp_path):
    from shoreline.plans import serving

    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([("a", "2024-01-08", 1)], "local string, dia string, v int")

    for _ in range(3):
        assert serving.served(spark, str(tmp_path), "t", build).count() == 1
    assert len(built) == 1
    serving.refresh(spark, str(tmp_path), "t")
    assert serving.served(spark, str(tmp_path), "t", build).count() == 1 and len(built) == 2
