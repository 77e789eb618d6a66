"""``numbered`` against a plain window: hot groups, ties, NULLs, every size."""

import pytest
from pyspark.sql import Window, functions as F

from patronage.operators import skew
from patronage.operators.skew import numbered

ORDER = ["a", "b", "id"]


def rows(spark, n, hot):
    i = F.col("id")
    group = F.when(i % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("G"), (i % 50).cast("string")))
    return spark.range(n).select(
        F.when(i % 10 < hot, F.lit("H")).otherwise(group).alias("p"),
        F.when(i % 11 != 0, (i * 7919) % 100).alias("a"), (i % 3).cast("decimal(10,2)").alias("b"), "id")


@pytest.mark.parametrize("hot", [0, 3, 10])
@pytest.mark.parametrize("by", ["p", None])
def test_equals_a_plain_window(spark, monkeypatch, hot, by):
    monkeypatch.setattr(skew, "SAMPLED_PER_CUT", 4)
    df = rows(spark, 6000, hot)
    w = Window.partitionBy(*([by] if by else [])).orderBy(*[F.col(c).asc_nulls_last() for c in ORDER])
    want = df.withColumn("n", F.row_number().over(w).cast("long"))
    got = numbered(df, by, ORDER, "n").select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_tied_rows_spread_over_ranges_get_different_numbers(spark, monkeypatch):
    monkeypatch.setattr(skew, "SAMPLED_PER_CUT", 4)
    got = numbered(spark.range(3000).select(F.lit("H").alias("p"), F.lit(1).alias("a")), "p", ["a"], "n")
    assert sorted(r.n for r in got.select("n").collect()) == list(range(1, 3001))


def test_empty_and_single_rows(spark):
    one = spark.createDataFrame([(None, None)], "p string, a int")
    assert [r.n for r in numbered(one, "p", ["a"], "n").collect()] == [1]
    assert numbered(one.where("false"), "p", ["a"], "n").collect() == []


def test_a_hot_group_is_no_single_task_and_rows_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(skew, "SAMPLED_PER_CUT", 4)
    df = spark.range(8000).select(F.lit("H").alias("p"), F.col("id").alias("a"))
    plan = numbered(df, "p", ["a"], "n")
    ranges = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(p" in ranges and "__range" in ranges
    # rows of one range are at most a few times an even share
    split = skew.numbered(df.withColumn("q", F.lit(0)), "p", ["a"], "n").where("n <= 8000")
    assert split.count() == 8000
