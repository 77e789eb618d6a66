"""Property tests: the rewritten operators equal their plain forms on random data."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from patronage.operators.skew import numbered

small = st.one_of(st.none(), st.integers(min_value=0, max_value=3))
rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["g1", "g2", "g3"])), small, small,
                          st.integers(min_value=0, max_value=10_000)), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_numbering_matches_window(spark, data):
    # a unique last key makes the numbering deterministic, so both forms must agree exactly
    data = [(g, a, b, i) for i, (g, a, b, _) in enumerate(data)]
    df = spark.createDataFrame(data, "g string, a int, b int, u int").repartition(3)
    order = ["a", "b", "u"]
    want = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("g").orderBy(*[F.col(c).asc_nulls_last() for c in order])))
    expected = sorted(want.collect(), key=repr)
    got = numbered(df, "g", order, "rn").select(*df.columns, "rn")
    assert sorted(got.collect(), key=repr) == expected


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([10, 20, 30]), st.one_of(st.none(), st.integers(0, 5)),
                          st.one_of(st.none(), st.integers(1, 4)), st.integers(0, 99)), min_size=1, max_size=40))
def test_last_gift_matches_the_window_form(make_tables, data):
    """``giving.last_gift`` equals the specification's two-window form."""
    import datetime as dt
    from decimal import Decimal

    from patronage.operators import giving
    from patronage.params import Params

    gifts = [(h, f"G{i}", None if d is None else 20000101 + d, s, 20001, 0, i, Decimal(a))
             for i, (h, d, s, a) in enumerate(data)]
    t = make_tables(adv_hh_giving_f=gifts, adv_gift_description_d=[(0, "N", "N")],
                    adv_campaign_d=[(20001, "AF", 19990701)],
                    adv_designation_d=[(k, f"D{k}") for k in range(1, 5)],
                    adv_calendar_dv=[(20000101 + d, dt.date(2000, 1, 1 + d), 2000) for d in range(6)])
    got = giving.last_gift(t, Params(fiscal_year=2000, school_code="x", class_segment=None, org_segment_labels=(), mail_labels=()))
    hhg = t.adv_hh_giving_f
    w1, w2 = Window.partitionBy("household_key"), Window.partitionBy("household_key", "date_key_gift")
    want = (hhg.withColumn("md", F.max("date_key_gift").over(w1))
            .withColumn("ms", F.max("designation_key").over(w2))
            .where((F.col("date_key_gift") == F.col("md")) & (F.col("designation_key") == F.col("ms")))
            .join(t.adv_calendar_dv.withColumnRenamed("date_key", "date_key_gift"), "date_key_gift")
            .join(t.adv_designation_d, "designation_key")
            .groupBy("household_key", "calendar_date", "fiscal_year", "designation_ld")
            .agg(F.sum("credit_amount").alias("gift_amount")))
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
