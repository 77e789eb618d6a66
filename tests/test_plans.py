"""Physical-plan properties that must hold at any scale."""

import re

import pytest

from patronage.plans.registry import QUERIES, run

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_cartesian_or_python(spark, name):
    plan = final_plan(run(name, spark, "/root/testdata/sf0.001"))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_gift_numbering_never_windows_a_whole_gift_number(spark):
    # rows are numbered per (gift number, range), a range being a bounded part
    # of a gift number, and the joined rows are shuffled once for it
    plan = final_plan(run("gift_extract", spark, "/root/testdata/sf0.001"))
    keys = re.findall(r"Window \[row_number\(\).*?\], \[([^\]]*)\]", plan)
    assert any(k.startswith("gift_number#") and ", __range#" in k for k in keys), keys


def test_fiscal_year_is_a_literal_filter_pushed_to_the_snapshot(spark):
    # the parameter is read once and inlined: the behavior snapshot is
    # filtered by a constant (no join against the parameter table)
    plan = final_plan(run("population_standard", spark, "/root/testdata/sf0.001"))
    assert "adv_reportvars" not in plan and "VOLUNTR_FY" not in plan
