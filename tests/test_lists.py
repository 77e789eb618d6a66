"""Lists by key ranges against one listagg per group."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from patronage.functions import ordered_listagg
from patronage.operators.lists import ordered_lists

keys = st.one_of(st.none(), st.integers(-20, 20), st.sampled_from([-(1 << 62), 1 << 62]))
values = st.one_of(st.none(), st.sampled_from(["", "a", "b; c", "\u00e9"]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["g", "h"])), keys, values, values), max_size=40),
       st.sampled_from([1, 4, 1 << 13]))
def test_equals_one_listagg_per_group(spark, data, width):
    df = spark.createDataFrame(data, "g string, k long, v string, w string").repartition(3)
    want = df.groupBy("g").agg(ordered_listagg("v", "; ", "k", "v").alias("a"), ordered_listagg("w", ", ", "k", "w").alias("b"))
    got = ordered_lists(df, "g", "k", {"a": ("v", "; "), "b": ("w", ", ")}, width)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_width_is_a_power_of_two(spark):
    with pytest.raises(ValueError):
        ordered_lists(spark.range(1), "id", "id", {}, 12)


def test_no_step_gathers_a_hot_group_whole(spark):
    df = spark.range(4000).selectExpr("id % 1 g", "id k", "cast(id as string) v")
    got = ordered_lists(df, "g", "k", {"a": ("v", ";")}, 256)
    assert got.first().a == ";".join(map(str, range(4000)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the rows meet by (group, range); only range lists meet by group
    assert "hashpartitioning(g" in plan and "__range" in plan
